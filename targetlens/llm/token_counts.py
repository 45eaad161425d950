"""Token counts by byte-pair merging with a heap over a linked list of symbols."""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTEXT_TOKENS = 2048
#: Words whose counts a task remembers; beyond it the memory is emptied, never the work left out.
REMEMBERED = 600_000

#: Letters, digits and lower-case pairs (first, last, distance) of the Unicode version of
#: the tokenizer library that the interpreter's tables may not know yet.
NEWER_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEWER_DIGITS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]
NEWER_LOWER = [
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
    (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
]


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class MergeCounter:
    """Number of tokens of a text under the merges of a byte-level BPE file with word ends.

    The file's settings are read, not assumed: pattern, word-end suffix, special tokens. A special
    token inside a text counts one and splits the text around it.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        #: (left id, right id) in one integer -> (rank, id of the merged symbol)
        self.merges = {(ids[a] << 32) | ids[b]: (i, ids[a + b]) for i, (a, b) in enumerate(pairs)}
        suffix = spec["model"]["end_of_word_suffix"] or ""
        self.inner = [ids[c] for c in byte_symbols()]
        self.final = [ids[c + suffix] for c in byte_symbols()]
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.seen: dict[str, int] = {}

    def word_tokens(self, word: str) -> int:
        """Initial symbols minus merges; the lowest rank is merged first, the leftmost of equals."""
        data = word.encode("utf-8", "replace")
        ids = [self.inner[b] for b in data]
        ids[-1] = self.final[data[-1]]
        n, merges = len(ids), self.merges
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merges.get((ids[i] << 32) | ids[i + 1])
            if found is not None:
                heap.append((found[0] << 40) | i)
        heapq.heapify(heap)
        done = 0
        while heap:
            top = heapq.heappop(heap)
            i = top & ((1 << 40) - 1)
            j = following[i]
            if j >= n or ids[i] < 0:
                continue
            found = merges.get((ids[i] << 32) | ids[j])
            if found is None or found[0] != top >> 40:
                continue  # one of the two has been merged since
            ids[i], ids[j] = found[1], -1
            following[i] = k = following[j]
            done += 1
            if k < n:
                previous[k] = i
                found = merges.get((ids[i] << 32) | ids[k])
                if found is not None:
                    heapq.heappush(heap, (found[0] << 40) | i)
            h = previous[i]
            if h >= 0:
                found = merges.get((ids[h] << 32) | ids[i])
                if found is not None:
                    heapq.heappush(heap, (found[0] << 40) | h)
        return n - done

    def _split(self, text: str) -> list[str]:
        """Matches of the file's pattern. Characters that the interpreter's tables do not assign are
        shown to it as a letter, digit or sign of known kind, as its tables may differ."""
        if text.isascii() or not any(unicodedata.category(c) == "Cn" for c in text):
            return self.pieces.findall(text)
        shape = "".join(_known_kind(c) for c in text)
        return [text[m.start():m.end()] for m in self.pieces.finditer(shape)]

    def _chunk(self, chunk: str) -> int:
        """Tokens of a stretch without blanks; remembered, as words come again and again."""
        plain = chunk.lower() if chunk.isascii() else lower_by_character(unicodedata.normalize("NFC", chunk))
        total, seen = 0, self.seen
        for word in self._split(plain):
            n = seen.get(word)
            if n is None:
                n = self.word_tokens(word)
                if len(word) <= 64:
                    seen[word] = n
            total += n
        if len(seen) >= REMEMBERED:
            seen.clear()
        if len(chunk) <= 64 and chunk != plain:
            seen[chunk] = total
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        total, stretches, seen = 0, [text], self.seen
        if self.specials is not None and self.specials.search(text):
            total = sum(1 for _ in self.specials.finditer(text))
            stretches = self.specials.split(text)
        for stretch in stretches:
            # blanks and line ends are never inside a word, so each stretch between them counts alone
            for chunk, times in Counter(stretch.replace("\n", " ").split(" ")).items():
                if chunk:
                    n = seen.get(chunk)
                    total += times * (self._chunk(chunk) if n is None else n)
        return total


def _within(code: int, ranges: list) -> tuple | None:
    return next((r for r in ranges if r[0] <= code <= r[1]), None)


def _known_kind(char: str) -> str:
    if unicodedata.category(char) != "Cn":
        return char
    return "a" if _within(ord(char), NEWER_LETTERS) else "1" if _within(ord(char), NEWER_DIGITS) else "#"


def lower_by_character(text: str) -> str:
    """Lower case of each character on its own: no special case for a final sigma."""
    lowered = "σ".join(part.lower() for part in text.split("Σ")) if "Σ" in text else text.lower()
    if any(unicodedata.category(c) == "Cn" for c in lowered):
        moved = [(c, _within(ord(c), NEWER_LOWER)) for c in lowered]
        return "".join(chr(ord(c) + r[2]) if r and unicodedata.category(c) == "Cn" else c for c, r in moved)
    return lowered


@cache
def merge_counter(path: str) -> MergeCounter:
    """One counter per Python worker and file."""
    return MergeCounter(path)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, n_bytes, n_tokens, over_limit) per row of ``docs``, over whole texts, without a shuffle.

    NULL and empty texts count zero. Repeated rows each keep their row; an empty table gives none.
    ``path`` must exist on every executor.
    """
    schema = T.StructType([
        T.StructField("_id", docs.schema[id_col].dataType),
        T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = merge_counter(path)
        for batch in batches:
            counts = [counter.count(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())],
                names=["_id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text_col).alias("t"),
    )
    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > CONTEXT_TOKENS)

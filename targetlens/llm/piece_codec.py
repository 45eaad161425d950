"""SentencePiece encoding and decoding: an Aho-Corasick automaton drives a single-pass Viterbi."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 300_000
#: Rows that are encoded or decoded before their result is handed on.
SLICE_ROWS = 256


class PieceCodec:
    """Best segmentation of a text into the pieces of a .model file, by the sum of their scores.

    The library only reads the file; segmentation and joining are done here. Pieces hold the space
    mark at their start or nowhere else, so the best path of a text is the best paths of its words
    one after the other, and those are remembered; if some piece does not, texts go whole. Of equal scores the longer last piece wins. A
    character without a piece costs ``UNKNOWN_PENALTY`` below the lowest score and is written as
    its bytes. Control pieces are never matched inside a text.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.automaton = ahocorasick.Automaton()
        self.bytes, self.pieces, scores = {}, [], []
        self.whole_words = True
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.pieces.append(piece)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                score = model.get_score(i)
                scores.append(score)
                self.automaton.add_word(piece, (len(piece), score, i))
                self.whole_words &= SPACE not in piece.lstrip(SPACE) and "\n" not in piece
        self.automaton.make_automaton()
        self.unknown_score = min(scores) - UNKNOWN_PENALTY
        self.unknown_id = model.unk_id()
        self.of_byte = {i: b for b, i in self.bytes.items()}
        marks = [bytes((self.of_byte[i],)) if i in self.of_byte else p.encode("utf-8") for i, p in enumerate(self.pieces)]
        #: the bytes that each piece stands for
        self.spelling = np.array(marks, dtype=object)
        #: words and their ids, four bytes each
        self.seen: dict[str, bytes] = {}

    def _best_path(self, text: str) -> bytes:
        """Matches come in order of their end, longest first along the output links; each relaxes
        the best score at its end, so one pass over the text finds the best path."""
        n = len(text)
        best = [0.0] + [float("-inf")] * n
        link = [(0, -1)] * (n + 1)  # start of the last piece and its id; -1 for an unknown character
        reached = 0

        def pass_unknown(upto: int) -> None:
            """A character that no piece of its own covers may be passed as unknown."""
            for at in range(reached, upto):
                score = best[at] + self.unknown_score
                if not single[at + 1] and score > best[at + 1]:
                    best[at + 1], link[at + 1] = score, (at, -1)

        single = [False] * (n + 1)
        for end, (length, score, piece) in self.automaton.iter(text):
            if end > reached:
                pass_unknown(end)
                reached = end
            start = end + 1 - length
            if length == 1:
                single[end + 1] = True
            total = best[start] + score
            if total > best[end + 1]:
                best[end + 1], link[end + 1] = total, (start, piece)
        pass_unknown(n)
        out, at = [], n
        while at:
            start, piece = link[at]
            if piece >= 0:
                out.append(piece)
            elif self.bytes:
                out.extend(self.bytes[b] for b in reversed(text[start:at].encode("utf-8", "replace")))
            else:
                out.append(self.unknown_id)
            at = start
        return np.array(out[::-1], dtype=np.int32).tobytes()

    def _remembered(self, word: str) -> bytes:
        ids = self.seen.get(word)
        if ids is None:
            ids = self._best_path(word)
            if len(word) <= 64:
                if len(self.seen) >= REMEMBERED:
                    self.seen.clear()
                self.seen[word] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Piece ids of the whole text; none for a NULL or empty one."""
        return np.frombuffer(self.encode_raw(text), dtype=np.int32).tolist()

    def encode_raw(self, text: str | None) -> bytes | bytearray:
        """The ids as 32-bit numbers.

        The text is cut before a space mark that follows another character and around line ends,
        which no piece spans; the best path of each stretch is the best path there of the whole.
        """
        if not text:
            return b""
        marked = SPACE + text.replace(" ", SPACE)
        if not self.whole_words:
            return self._best_path(marked)
        out, seen = bytearray(), self.seen
        for n, line in enumerate(marked.split("\n")):
            if n:
                out += self._remembered("\n")
            first, *others = line.split(SPACE)
            if first:
                out += self._remembered(first)
            held = ""
            for word in others:
                held += SPACE
                if word:  # a run of spaces belongs to the word after it
                    held += word
                    out += seen.get(held) or self._remembered(held)
                    held = ""
            if held:
                out += self._remembered(held)
        return out

    def decode(self, ids: list[int] | np.ndarray | None) -> str:
        """The text of the pieces: bytes are joined, the mark becomes a space, the first one goes."""
        if ids is None or not len(ids):
            return ""
        raw = b"".join(self.spelling[np.asarray(ids)].tolist())
        return raw.decode("utf-8", "replace").replace(SPACE, " ")[1:]


@cache
def piece_codec(path: str) -> PieceCodec:
    """One codec per Python worker and file."""
    return PieceCodec(path)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that ids and texts of a part are small."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def encode_pieces(
    docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "piece_ids", check_col: str | None = None
) -> DataFrame:
    """``docs`` with ``ids_col`` (array of int) added, without a shuffle.

    With ``check_col`` the ids are decoded again in the same pass and the column tells whether that
    gives the text back. A NULL or empty text has no pieces. The space mark itself in a text reads
    as a space, as in the library. Repeated rows each keep their row; an empty table gives none;
    other columns are kept, and columns of the names that are added are replaced.
    """
    added = [T.StructField(ids_col, T.ArrayType(T.IntegerType()))]
    if check_col:
        added.append(T.StructField(check_col, T.BooleanType()))
    rest = [c for c in docs.columns if c not in {f.name for f in added}]
    schema = T.StructType([docs.schema[c] for c in rest] + added)
    at = rest.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(path)
        for batch in _slices(batches):
            texts = batch.column(at).to_pylist()
            raw = [codec.encode_raw(t) for t in texts]
            ends = np.cumsum([0, *(len(r) // 4 for r in raw)], dtype=np.int32)
            flat = pa.array(np.frombuffer(b"".join(raw), dtype=np.int32), pa.int32())
            out = [*batch.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
            if check_col:
                back = [codec.decode(np.frombuffer(r, dtype=np.int32)) for r in raw]
                out.append(pa.array([b == (t or "").replace(SPACE, " ") for b, t in zip(back, texts)], pa.bool_()))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return docs.select(*rest).mapInArrow(run, schema)


def decode_pieces(docs: DataFrame, path: str, ids_col: str = "piece_ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids_col`` as ``text_col``; no ids give an empty text."""
    rest = [c for c in docs.columns if c != text_col]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField(text_col, T.StringType())])
    at = rest.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(path)
        for batch in _slices(batches):
            column = batch.column(at)
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            present = column.is_valid().to_pylist()
            texts = pa.array([codec.decode(flat[a:b]) if here else "" for a, b, here in zip(ends, ends[1:], present)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*rest, text_col])

    return docs.select(*rest).mapInArrow(run, schema)


def piece_report(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, number of pieces, hash of the ids, whether decoding gives the text back."""
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    return encode_pieces(texts, path, "_t", check_col="round_trip").select(
        F.col("_id").alias("doc_id"), F.size("piece_ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("piece_ids", ","), 256).alias("ids_sha256"), "round_trip",
    )

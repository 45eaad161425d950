"""Personal data: labelers vote on candidate spans, EM weighs the labelers, a classifier decides."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from targetlens.llm.common import Scratch

KINDS = ["email", "ip", "card", "phone"]
#: Kinds that only the method finds, after the base kinds in every listing.
MORE_KINDS = ["iban", "national_id"]
LABELERS = ["strict form", "check digits", "gazetteer", "context", "edges"]
#: Spans on which the final classifier is fitted; votes are counted over all spans.
TRAINING_SPANS = 20_000
EM_ROUNDS = 50
CONTEXT_CHARS = 40

#: Words that announce a kind, words that announce another number.
CUES = {
    "email": ["mail", "e-mail", "email", "correo", "courriel", "contact", "write", "@"],
    "ip": ["ip", "host", "server", "address", "adresse", "servidor", "ping"],
    "card": ["card", "visa", "mastercard", "amex", "credit", "kreditkarte", "karte", "carte", "tarjeta"],
    "phone": ["phone", "tel", "call", "fax", "mobile", "telefon", "handy", "téléphone", "teléfono", "whatsapp"],
    "iban": ["iban", "account", "konto", "compte", "cuenta", "bank", "banque", "banco"],
    "national_id": ["ssn", "social", "security", "id", "identity", "ausweis"],
}
OTHER_CUES = ["version", "isbn", "issn", "order", "invoice", "page", "section", "chapter", "part", "item", "§"]
#: Common top-level domains, country calling codes, issuer prefixes of cards.
DOMAINS = set("com org net edu gov io de fr es it nl uk us eu at ch be pl info biz dev co ca mx br au jp in".split())
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "4", "5", "6", "8", "9")
ISSUERS = ("34", "37", "36", "38", "30", "35", "4", "51", "52", "53", "54", "55", "2", "6")
IBAN_LANDS = set("AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())

DIGIT = re.compile("[0-9]")
LOCAL_TAIL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SPOKEN_DOT = re.compile(r"[ \[(]dot[ \])]", re.I)
SPOKEN = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{2,24})+", re.I)
SPLIT_PHONE = re.compile(r"(?<![0-9.+-])(?:00[1-9][0-9]{0,2}[ .-])?\(?0?[0-9]{2,4}\)?[ .-][0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9.-])")
GROUPS = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) * (1 + place % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their @, in linear time."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL_TAIL.match(text, start - 1, start):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base forms of the four kinds, each leftmost and non-overlapping; failing matches go."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return out
    for m in DOTTED.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in DIGITS.finditer(text):
        if len(m[0]) >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PLUS.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def loose_spans(text: str) -> list[tuple[str, int, int]]:
    """Further candidates: spoken addresses, unprefixed phones, short cards, other identifiers."""
    out = []
    if SPOKEN_DOT.search(text):
        out += [("email", *m.span()) for m in SPOKEN.finditer(text)]
    if not DIGIT.search(text):
        return out
    if ":" in text:
        out += [("ip", *m.span()) for m in GROUPS.finditer(text)]
    out += [("card", *m.span()) for m in DIGITS.finditer(text) if 13 <= len(_digits(m[0])) <= 19]
    out += [("phone", *m.span()) for m in SPLIT_PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    out += [("iban", *m.span()) for m in IBAN.finditer(text)]
    out += [("national_id", *m.span()) for m in NATIONAL.finditer(text)]
    return out


def votes(text: str, kind: str, start: int, end: int, strict: bool) -> list[int]:
    """+1, -1 or 0 (abstains) of each labeler."""
    span = text[start:end]
    digits = _digits(span)
    check = gazetteer = 0
    if kind == "card":
        check = 1 if luhn(digits) else -1
        gazetteer = 1 if digits.startswith(ISSUERS) else -1
    elif kind == "iban":
        plain = span.replace(" ", "")
        check = 1 if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 else -1
        gazetteer = 1 if span[:2] in IBAN_LANDS else -1
    elif kind == "ip":
        check = 1 if ":" in span or all(len(p) == len(p.lstrip("0") or "0") for p in span.split(".")) else -1
    elif kind == "phone":
        check = 1 if 9 <= len(digits) <= 13 else -1
        gazetteer = (1 if digits.startswith(CALLING) else -1) if span.startswith("+") else 0
    elif kind == "email":
        last = re.split(r"[.\s\])]+", span)[-1].lower()
        gazetteer = 1 if last in DOMAINS else -1
    elif kind == "national_id":
        check = -1 if span.startswith(("000", "666", "9")) or span[4:6] == "00" or span.endswith("0000") else 1
    before = text[max(0, start - CONTEXT_CHARS):start].lower()
    words = re.findall(r"[^\W\d_]+|[@§]", before)[-5:]
    context = 1 if any(w in CUES[kind] for w in words) else -1 if any(w in OTHER_CUES for w in words) else 0
    around = text[start - 1:start] + text[end:end + 1] if start else text[end:end + 1]
    edges = -1 if any(c.isalnum() or c in "@_/\\=" for c in around) else 1
    return [1 if strict else -1, check, gazetteer, context, edges]


def candidates(text: str | None) -> list[dict]:
    """Base spans, and loose ones that overlap no base span and no earlier loose one."""
    if not text:
        return []
    found = [(k, a, b, True) for k, a, b in base_spans(text)]
    taken = sorted((a, b) for _, a, b, _ in found)
    more = []
    for kind, a, b in sorted(loose_spans(text), key=lambda s: (s[1], -s[2], s[0])):
        more.append((kind, a, b))
    last, at = -1, 0
    for kind, a, b in more:
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if a >= last and not any(x < b and a < y for x, y in taken[max(0, at - 2):at + 3]):
            found.append((kind, a, b, False))
            last = b
    return [
        {"kind": k, "start": a, "end": b, "base": base, "votes": votes(text, k, a, b, base)}
        for k, a, b, base in found
    ]


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType()),
    T.StructField("votes", T.ArrayType(T.IntegerType())),
]))
SPANS_ARROW = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()),
    ("votes", pa.list_(pa.int32())),
]))


def _candidate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [candidates(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, SPANS_ARROW)], names=["_id", "spans"])


def estimate_reliabilities(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray]:
    """(share of true spans, P(vote | truth)) by expectation-maximisation from counted vote patterns.

    The table of probabilities is indexed [labeler, truth, vote + 1]. It starts from the belief
    that labelers are right more often than not, which tells the two classes apart.
    """
    seen = np.array([p for p, _ in patterns]) + 1
    weight = np.array([n for _, n in patterns], dtype=float)
    n_labelers = seen.shape[1]
    prior = np.array([0.5, 0.5])
    table = np.tile(np.array([[0.5, 0.3, 0.2], [0.2, 0.3, 0.5]]), (n_labelers, 1, 1))
    for _ in range(EM_ROUNDS):
        posterior = truth_given_votes(seen - 1, prior, table)
        belief = np.stack([1 - posterior, posterior], axis=1) * weight[:, None]
        prior = (belief.sum(axis=0) + 1) / (belief.sum() + 2)
        for labeler in range(n_labelers):
            for vote in range(3):
                table[labeler, :, vote] = belief[seen[:, labeler] == vote].sum(axis=0) + 1
        table /= table.sum(axis=2, keepdims=True)
    return prior, table


def truth_given_votes(seen: np.ndarray, prior: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Posterior probability of a true span for rows of votes."""
    logs = np.log(prior)[None, :] + sum(np.log(table[j][:, seen[:, j] + 1]).T for j in range(seen.shape[1]))
    return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))


def features(kind: str, length: int, seen: list[int]) -> list[float]:
    kinds = [float(kind == k) for k in KINDS + MORE_KINDS]
    return [1.0, *kinds, min(length, 64) / 64, *[float(v == 1) for v in seen], *[float(v == -1) for v in seen]]


def fit_classifier(rows: list[tuple[str, int, list[int]]], target: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Logistic weights against soft targets, by gradient descent with a small penalty."""
    x = np.array([features(*r) for r in rows])
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-x @ weights)) - target
        weights -= 1.0 * (x.T @ error / len(x) + 1e-4 * weights)
    return weights


def _decide(weights: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = {k: i for i, k in enumerate(KINDS + MORE_KINDS)}
        for batch in batches:
            out = []
            for row in batch.column(1).to_pylist():
                kept = [
                    s for s in row or []
                    if s["base"] or (weights is not None and float(np.dot(
                        weights, features(s["kind"], s["end"] - s["start"], s["votes"]))) > 0)
                ]
                out.append(sorted(kept, key=lambda s: (order[s["kind"]], s["start"], s["end"])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, SPANS_ARROW)], names=["_id", "spans"])

    return run


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, spans) per row of ``docs``: kind, start, end (code points, end exclusive), base, votes.

    The texts are read once; what follows works on the candidate spans. Vote patterns are counted
    over all of them and only the counts (at most 3 ** labelers per kind) reach the driver for EM,
    one run per kind. The classifier is fitted on at most ``TRAINING_SPANS`` spans. NULL and empty
    texts have no spans; repeated rows each keep their row; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    schema = T.StructType([T.StructField("_id", docs.schema[id_col].dataType), T.StructField("spans", SPANS)])
    found = scratch.keep(
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("t")).mapInArrow(_candidate_batches, schema)
    )
    each = found.select("_id", F.explode("spans").alias("s"))
    counted = each.groupBy("s.kind", "s.votes").count().collect()
    known = {}
    for kind in sorted({r["kind"] for r in counted}):
        patterns = sorted((tuple(r["votes"]), r["count"]) for r in counted if r["kind"] == kind)
        known[kind] = estimate_reliabilities(patterns)
    weights = None
    if known:
        # the smallest hashes: few more rows than wanted pass, so that no task sends its own first ones
        share = 1.2 * TRAINING_SPANS / sum(r["count"] for r in counted)
        few = F.lit(True) if share >= 1 else F.xxhash64("_id", "start", "kind") < F.lit(int(share * 2**64) - 2**63)
        sample = (
            each.select("s.kind", (F.col("s.end") - F.col("s.start")).alias("n"), "s.votes", "s.start", "_id")
            .where(few).orderBy(F.xxhash64("_id", "start", "kind"), "kind", "n", "votes").limit(TRAINING_SPANS).collect()
        )
        rows = [(r["kind"], r["n"], list(r["votes"])) for r in sample]
        target = np.array([truth_given_votes(np.array([v]), *known[k])[0] for k, _, v in rows])
        weights = fit_classifier(rows, target)
    return found.mapInArrow(_decide(weights), schema)


def personal_data_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, counts of the base kinds, hash of the base spans, all spans as text."""
    told = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["base"])
    number = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return find_personal_data(docs, id_col, text_col).select(
        F.col("_id").alias("doc_id"),
        *[number(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"),
    )

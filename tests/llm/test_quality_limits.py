"""The learned limits of the quality rules: each can reject, and they follow their group."""

import pytest

from targetlens.llm.quality_rules import TAILS, learned_limits, quality_report

WORDS = [a + b for a in ("ba", "ke", "lo", "mi", "nu", "se") for b in ("dam", "fer", "gol", "hin", "jun", "lat", "mek", "nil", "pos")]


def usual(i, extra=""):
    """A text of six lines, all words different, and ``extra`` behind."""
    return "\n".join(f"{' '.join(WORDS[k:k + 9])} {i * 7 + k}x" for k in range(0, 54, 9)) + extra


ODD = {
    "symbol_rate": usual(1, "\n" + "#" * 8),
    "dup_line_rate": usual(1, "\none\ntwo\none\ntwo\none\ntwo"),
    "repeat_rate": usual(1, "\nthis is said once again this is said once again"),
    "mean_word": usual(1, "\n" + " ".join("incomprehensibilities" + str(k) for k in range(6))),
    "shout_rate": usual(1, "\nWHY SO LOUD"),
}


@pytest.mark.parametrize("rule", list(ODD))
def test_each_rule_rejects(spark, rule):
    rows = [(i, usual(i), "en", "s") for i in range(300)] + [(1000, ODD[rule], "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = quality_report(docs).collect()
    assert not any(r["base_failed"] for r in got)
    assert {r["doc_id"] for r in got if not r["kept"]} == {1000}


def rates(spark, *groups):
    rows = [(lang, source, *[scale * (j % 50) / 50 for _ in TAILS]) for lang, source, n, scale in groups for j in range(n)]
    return spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"{n} double" for n in TAILS))


def test_limits_differ_between_groups(spark):
    limits = {r["source"]: r for r in learned_limits(rates(spark, ("en", "a", 1000, 0.1), ("en", "b", 1000, 0.4))).collect()}
    for name in TAILS:
        assert limits["b"][f"high_{name}"] > 1.8 * limits["a"][f"high_{name}"], name


def test_limits_move_smoothly_with_size(spark):
    """A source of its own kind next to a large one: its limits leave the language's little by little."""
    high = []
    for n in (50, 150, 199, 200, 250, 1000, 4000):
        limits = learned_limits(rates(spark, ("en", "a", 4000, 0.1), ("en", "b", n, 0.4))).where("source = 'b'").first()
        high.append(limits["high_symbol_rate"])
    assert abs(high[3] - high[2]) < 0.02 * high[2]
    assert high[0] < 0.8 * high[5] and high[1] < high[5] <= 1.02 * high[6]


def test_the_same_limits_for_labelled_texts(spark):
    """Good texts stay and bad ones go, also where every source is small."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality_report(docs).where("not base_failed").join(labels, "doc_id").groupBy("quality").agg(
        {"*": "count", "kept": "count_if"}).collect()
    share = {r["quality"]: r["count_if(kept)"] / r["count(1)"] for r in got}
    print(share)
    assert share[1] >= 0.97 and share[0] <= 0.05

"""Rules by divergence against a plain version."""

import math
import re
from collections import Counter, defaultdict

import pytest

from meterflow.llm import quality_divergence as q
from meterflow.llm.common import table


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def base(text):
    text = text or ""
    words = words_of(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    twice = Counter(windows)
    covered = {j for i, w in enumerate(windows) if twice[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words_of(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def distance(p, r):
    a, b = max(1.0, sum(p)), max(1.0, sum(r))
    total = 0.0
    for x, y in zip(p, r, strict=True):
        x, y = x / a, y / b
        total += sum(u * math.log2(2 * u / (x + y)) for u in (x, y) if u > 0) / 2
    return math.sqrt(max(0.0, total))


def verdicts(rows):
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        counts[lang].update(w for w in words_of(text) if len(w) <= q.COMMON_LETTERS)
    common = {lang: [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[:q.COMMON]] for lang, c in counts.items()}
    each = []
    for _, text, lang in rows:
        text, words = text or "", words_of(text)
        classes = [sum(c.isupper() and c.istitle() or c.isupper() for c in text), sum("0" <= c <= "9" for c in text),
                   sum(c in ".,;:!?'\"()-" for c in text), sum(c in "#*$%&|<>" for c in text)]
        solid = sum(map(len, words))
        classes += [solid - sum(classes), len(text) - solid]
        of = Counter(words)
        seen = [of[w] for w in common[lang]]
        each.append((classes, [*seen, len(words) - sum(seen)]))
    sums = {}
    for (_, _, lang), (c, w) in zip(rows, each, strict=True):
        s = sums.setdefault(lang, ([0] * len(c), [0] * len(w)))
        for total, part in zip(s, (c, w), strict=True):
            total[:] = [x + y for x, y in zip(total, part, strict=True)]
    out = []
    for (i, text, lang), (c, w) in zip(rows, each, strict=True):
        figures = base(text)
        far = figures[0] >= q.LEAST_WORDS and (distance(c, sums[lang][0]) > q.FAR_CLASSES or distance(w, sums[lang][1]) > q.FAR_WORDS)
        out.append((i, *figures, not figures[-1] and not far))
    return sorted(out, key=str)


FIELDS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def test_rules_equal_the_plain_version(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    assert sorted((tuple(r) for r in q.judged(docs).select(*FIELDS).collect()), key=str) == verdicts(rows)


def test_clean_documents_stay_and_bad_ones_go(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    found = q.judged(docs).join(labels, "doc_id").where("not base_failed")
    shares = {r.quality: r.share for r in found.groupBy("quality").agg({"kept": "count"}).select("quality").join(
        found.selectExpr("quality", "int(kept) as k").groupBy("quality").avg("k").withColumnRenamed("avg(k)", "share"), "quality").collect()}
    assert shares[1] > 0.999 and shares[0] < 0.6


def test_odd_rows(spark):
    block = "one two three four five six seven eight nine "
    rows = [(1, None, "en"), (2, "", None), (3, " \n\n ", "en"), (4, block * 3, "en"), (4, block * 3, "en"),
            (5, "Line one here\nLine one here\n\n \nother", None), (6, "w" + " w" * 50_000, "de"), (None, "ein Text #1 & <b> É", "de"),
            (7, " ".join(f"w{i}" for i in range(30)), "fr"), (8, "a\x0bb\x0cc\rd e", "fr")]
    df = spark.createDataFrame([(*r, 0, True) for r in rows], "doc_id long, text string, lang string, n_words int, kept boolean")
    got = sorted((tuple(r) for r in q.judged(df).select(*FIELDS).collect()), key=str)
    assert [g[:-1] for g in got] == sorted([(i, *base(t)) for i, t, _ in rows], key=str)
    assert q.judged(df.limit(0)).count() == 0


@pytest.mark.parametrize("most", [q.BROADCAST_LANGUAGES, 10])
def test_every_one_of_many_languages_has_its_reference(spark, tmp_path, monkeypatch, most):
    """Also where the table of languages is too large to be broadcast, and equal to the SQL."""
    import duckdb

    from tests.compare import compare

    monkeypatch.setattr(q, "BROADCAST_LANGUAGES", most)
    rows = []
    for i in range(1500):
        text = " ".join(f"{'AbC'[i % 3]}w{i % 7}{k % 9}{'.' * (k % 4)}" for k in range(60))
        rows += [(2 * i, text, f"lang{i}"), (2 * i + 1, text if i % 5 else "#1 " * 55 + "x y z", f"lang{i}")]
    rows += [(9001, " ... ", "mute"), (9002, None, "mute"), (9003, "a b " * 30, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    build = lambda s, d: q.judged(table(s, d, "documents")).drop("js_classes", "js_words")
    assert compare(spark, con, "op5", build, q.ORACLE, str(tmp_path)) is None
    found = q.judged(docs)
    assert found.where("n_words > 0 and (js_classes is null or js_words is null)").count() == 0
    assert sorted((tuple(r) for r in found.select(*FIELDS).collect()), key=str) == verdicts(rows)


def test_an_absent_histogram_has_no_distance(spark):
    from pyspark.sql import functions as F
    none = F.lit(None).cast("array<double>")
    assert spark.range(1).select(q.distance(F.array(F.lit(1.0)), none).alias("d")).first().d is None


@pytest.mark.parametrize("p, r, want", [([1, 0], [0, 1], 1.0), ([2, 2], [1, 1], 0.0), ([0, 0], [1, 1], None)])
def test_distance(spark, p, r, want):
    from pyspark.sql import functions as F
    array = lambda x: F.array(*[F.lit(float(v)) for v in x])
    got = spark.range(1).select(q.distance(array(p), array(r)).alias("d")).first().d
    assert got == pytest.approx(distance(p, r) if want is None else want, abs=1e-9)


def test_no_python_on_the_executors(spark, sf_dir):
    plan = q.judged(table(spark, sf_dir, "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_common_words_are_counted_without_a_call_for_each(spark):
    texts = ["\n a b \t", "a\r\n", " \t ", "", None, "a b c", "a muchlonger muchlonger", "\x0ba b"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)] + [(8, "", "de")], "doc_id long, text string, lang string")
    common = q.common_words(df)
    assert "lambda" not in common._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in common.collect()] == [("en", ["a", "b", "c"])]

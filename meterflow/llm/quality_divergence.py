"""Quality rules by distribution divergence, in DataFrame functions only.

Each document's histograms of character classes and of its language's most common words
are compared with the language's own, summed over all its documents, by Jensen-Shannon
distance. Texts that are too short for a histogram are not judged by it. Beside that,
plain counts give a base rule on length and repeated passages.

Defined results: null is as empty text, with no words, and fails the base rule; a null
language is a language of its own; repeated rows are judged one by one; every language has
a reference, and a text whose language has no words at all has no distance of words.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.common import kept

#: White space between words, characters that count as symbols.
SPACES, SYMBOLS = r"[\x20\x09-\x0D]+", r"[#*$%&|<>]"
CLASSES = {"upper": r"\p{Lu}", "digit": r"[0-9]", "mark": r"[.,;:!?'\"()-]", "symbol": SYMBOLS}
#: Common words per language and their length at most.
COMMON, COMMON_LETTERS = 16, 8
#: Languages, and bytes of their names, up to which what is known of them is broadcast; beyond
#: it the join is left to adaptive execution, with the same result.
BROADCAST_LANGUAGES, BROADCAST_BYTES = 20_000, 1 << 20
#: Words that a text needs to be compared, and distances from which it is refused.
LEAST_WORDS, FAR_CLASSES, FAR_WORDS = 50, 0.3, 0.45


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def common_words(docs: DataFrame, size: int = COMMON) -> DataFrame:
    """lang and its most frequent short words, counted over all documents.

    Ranks are taken in 32 parts of a language first, so none meets in one task whole.
    """
    each = docs.select("lang", F.explode(F.split("text", SPACES)).alias("word"))  # not filtered in the array: a call for each word
    counts = each.where((F.col("word") != "") & (F.length("word") <= COMMON_LETTERS)).groupBy("lang", "word").count()
    best = [F.desc("count"), F.asc("word")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("word"), F.lit(32))).orderBy(*best)
    whole = Window.partitionBy("lang").orderBy(*best)
    top = counts.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= size)
    top = top.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= size)
    return top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word")))["word"].alias("common")).select(
        F.col("lang").alias("of"), "common")


def small(languages: DataFrame) -> bool:
    """Whether a table with a row per language, ``of``, is small enough to be broadcast."""
    many, named = languages.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("of")), F.lit(0))).first()
    return many <= BROADCAST_LANGUAGES and named <= BROADCAST_BYTES


def figures(docs: DataFrame, common: DataFrame) -> DataFrame:
    """Counts of every document: the base figures, character classes and common words.

    Windows of 8 words are compared by hashes, built from those of 1, 2 and 4 words; only
    where a hash occurs twice are the windows' places sorted and the words they cover
    counted.
    """
    text = F.coalesce("text", F.lit(""))
    one = docs.select("doc_id", "lang", text.alias("text"), words(F.col("text")).alias("w"))
    one = one.join(common, F.col("lang").eqNullSafe(F.col("of")), "left")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    one = one.select(
        "doc_id", "lang", "w", "common",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length("text").cast("long").alias("chars"), lines.alias("lines"),
        *[F.regexp_count("text", F.lit(p)).cast("long").alias(f"class_{name}") for name, p in CLASSES.items()],
        F.transform("w", lambda x: F.xxhash64(x)).alias("h1"),
        F.filter("w", lambda x: F.array_contains("common", x)).alias("seen"))
    kept_columns = ["doc_id", "lang", "n_words", "word_chars", "chars", *[f"class_{name}" for name in CLASSES]]
    two = one.select(
        *kept_columns, (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("common", lambda r: F.size(F.filter("seen", lambda x: x == r)).cast("long")).alias("common_counts"),
        F.transform("h1", lambda x, i: F.xxhash64(x, F.get("h1", i + 1))).alias("h2"))
    kept_columns += ["n_dup_lines", "common_counts"]
    four = two.select(*kept_columns, F.transform("h2", lambda x, i: F.xxhash64(x, F.get("h2", i + 2))).alias("h4"))
    eight = four.select(*kept_columns, F.transform(
        F.slice("h4", F.lit(1), F.greatest(F.lit(0), F.col("n_words").cast("int") - 7)),
        lambda x, i: F.xxhash64(x, F.get("h4", i + 4))).alias("h8"))
    placed = eight.select(*kept_columns, F.when(
        F.size(F.array_distinct("h8")) < F.size("h8"),
        F.array_sort(F.transform("h8", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("s"))
    twice = F.filter("s", lambda x, j: (x.h == F.get("s", j + 1).h) | (x.h == F.get("s", j - 1).h))
    covered = F.aggregate(
        F.array_sort(F.transform(twice, lambda x: x.i)), F.struct(F.lit(0).alias("n"), F.lit(-8).alias("last")),
        lambda a, p: F.struct((a.n + F.least(F.lit(8), p - a.last)).alias("n"), p.alias("last")), lambda a: a.n)
    return placed.select(*kept_columns, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, 0 to 1, of two histograms given as arrays of counts."""
    def total(a: Column) -> Column:
        return F.greatest(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), F.lit(1.0))

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    shares = F.zip_with(p, q, lambda x, y: F.struct((x / total(p)).alias("p"), (y / total(q)).alias("q")))
    divergence = F.aggregate(shares, F.lit(0.0), lambda s, b: s + (part(b.p, b.q) + part(b.q, b.p)) / 2)
    return F.when(p.isNotNull() & q.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), divergence)))


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, the base figures, base_failed and kept, with both distances, of every document."""
    common = kept(common_words(docs), "common-words")
    few = small(common)
    each = kept(figures(docs, F.broadcast(common) if few else common), "figures")
    letters = F.col("word_chars") - sum(F.col(f"class_{name}") for name in CLASSES)
    classes = F.array(*[F.col(f"class_{name}") for name in CLASSES], letters, F.col("chars") - F.col("word_chars"))
    seen = F.aggregate("common_counts", F.lit(0).cast("long"), lambda s, x: s + x)
    of_words = F.concat("common_counts", F.array(F.col("n_words") - seen))
    each = each.withColumn("classes", F.transform(classes, lambda x: x.cast("double"))).withColumn(
        "of_words", F.transform(of_words, lambda x: x.cast("double")))
    sums = [F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES) + 2)]
    sums += [F.sum(F.get("of_words", F.lit(i))).alias(f"w{i}") for i in range(COMMON + 1)]
    reference = each.groupBy("lang").agg(*sums).select(
        F.col("lang").alias("of"), F.array(*[f"c{i}" for i in range(len(CLASSES) + 2)]).alias("ref_classes"),
        F.filter(F.array(*[f"w{i}" for i in range(COMMON + 1)]), lambda x: x.isNotNull()).alias("ref_words"))
    with_reference = each.join(F.broadcast(reference) if few else reference, F.col("lang").eqNullSafe(F.col("of")), "left")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    far = (F.col("js_classes") > FAR_CLASSES) | (F.col("js_words") > FAR_WORDS)
    return with_reference.select(
        "doc_id", "n_words", "word_chars", F.col("class_symbol").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), distance(F.col("classes"), F.col("ref_classes")).alias("js_classes"),
        distance(F.col("of_words"), F.col("ref_words")).alias("js_words"),
    ).withColumn("kept", ~F.col("base_failed") & ~((F.col("n_words") >= LEAST_WORDS) & F.coalesce(far, F.lit(False))))


_SEEN = ", ".join(f"coalesce(count(*) FILTER (WHERE word = common[{i}]), 0)" for i in range(1, COMMON + 1))
#: The same for DuckDB.
ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), each AS (
  SELECT r, lang, w, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d
), ranked AS (
  SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS rank
  FROM each WHERE length(word) <= {COMMON_LETTERS} GROUP BY lang, word
), common AS (
  SELECT lang AS of, list(word ORDER BY rank) AS common FROM ranked WHERE rank <= {COMMON} GROUP BY lang
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(w[i:i + 7], ' ')) AS times FROM each WHERE i <= len(w) - 7
), repeated AS (
  SELECT r, count(DISTINCT i + k) AS n FROM windows CROSS JOIN (SELECT unnest(range(8)) AS k) WHERE times > 1 GROUP BY r
), seen AS (
  SELECT r, [{_SEEN}] AS seen FROM each LEFT JOIN common ON lang IS NOT DISTINCT FROM of GROUP BY r
), figures AS (
  SELECT d.r, doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')) AS n_symbols,
    len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, length(text) AS chars,
    length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS upper,
    length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS digit,
    length(text) - length(regexp_replace(text, '[.,;:!?''"()-]', '', 'g')) AS mark,
    coalesce(seen, [{", ".join(["0"] * COMMON)}]) AS seen
  FROM d LEFT JOIN repeated USING (r) LEFT JOIN seen USING (r)
), histograms AS (
  SELECT *, [upper, digit, mark, n_symbols, word_chars - upper - digit - mark - n_symbols, chars - word_chars] AS p1,
    list_append(seen, n_words - list_sum(seen)) AS p2 FROM figures
), sums AS (
  SELECT lang AS of, [{", ".join(f"sum(p1[{i}])" for i in range(1, 7))}] AS q1, [{", ".join(f"sum(p2[{i}])" for i in range(1, COMMON + 2))}] AS q2
  FROM histograms GROUP BY lang
), pairs AS (
  SELECT r, unnest([0, 1]) AS kind, unnest([p1, p2]) AS p, unnest([q1, q2]) AS q FROM histograms JOIN sums ON lang IS NOT DISTINCT FROM of
), shares AS (
  SELECT r, kind, unnest(p)::DOUBLE / greatest(1, list_sum(p)) AS x, unnest(q)::DOUBLE / greatest(1, list_sum(q)) AS y FROM pairs
), far AS (
  SELECT r, bool_or(d > CASE kind WHEN 0 THEN {FAR_CLASSES} ELSE {FAR_WORDS} END) AS far FROM (
    SELECT r, kind, sqrt(greatest(0, sum(CASE WHEN x > 0 THEN x * log2(2 * x / (x + y)) ELSE 0 END
      + CASE WHEN y > 0 THEN y * log2(2 * y / (x + y)) ELSE 0 END) / 2)) AS d FROM shares GROUP BY r, kind) GROUP BY r
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (n_words >= {LEAST_WORDS} AND far) AS kept
FROM figures JOIN far USING (r)
"""

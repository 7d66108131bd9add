"""Repeated lines: equal ones, and those one word away, by a deletion-neighbourhood join.

A line is its words. It goes if an equal line, or one that differs by one word
added, dropped or changed, stands earlier in the corpus: in a document with a
smaller id, or before it in its own. Lines of fewer than ``NEAR_WORDS`` words
must be equal: one of their words is more than a fifth of them, which is less
alike than near copies have to be. Every step is a column expression, a grouping or a join.

Documents are numbered in order, so a line's place is one number, and lines can
be summed up by hash. Equal lines become one, at their first place. Two lines
one word apart agree in their first or their second half, so the halves are
hashed first; only lines that share such a key go on, and only the words of the
other half are deleted one by one. A line without its word at a position is a
key that it shares with every line that has another word there; without a word
at all, it is the key of a line that is one word shorter. Of each key the
earliest line counts, never a pair of all; its distance is then verified. Texts
are shuffled once.

Defined results: lines without words always stay. A null text has no lines and
stays null. Rows without an id come last in order; equal rows are one document.
A text has fewer than 2**28
lines. An empty table gives an empty result. Columns other than ``doc_id`` and
``text`` are only carried along. Lines are told apart by 128-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideferry.functions.frames import computed_once
from tideferry.llm.joins import with_index
from tideferry.llm.numbering import running
from tideferry.llm.words import BLANKS, PLAIN_WORD, words_of

# One word in so many is a similarity of 0.8.
NEAR_WORDS = 5

# A place is a document's number and the line's, which has so many bits.
_LINE_BITS = 28
_HALVES = 4


def _numbered(docs: DataFrame) -> DataFrame:
    """``key`` and ``number`` of every document, in the order of their ids."""
    keys = docs.select("key", "doc_id").distinct()
    keys = keys.select("key", "doc_id", F.col("doc_id").isNull().alias("no_id"), F.lit(1).alias("one"))
    return running(keys, ["no_id", "doc_id", "key"], "one").withColumnRenamed("begin", "number")


def _place() -> Column:
    return F.col("number") * (1 << _LINE_BITS) + F.col("line")


def _number(place: str) -> Column:
    return F.shiftright(place, _LINE_BITS)


def _half_keys() -> list[Column]:
    """Hashes of a line's first and second half, as long as it is and as if it were one word shorter.

    Halves are measured from both ends, so that a word more or less in one
    leaves the other where it is.
    """
    keys = []
    for size in ("n", "(n - 1)"):
        half = f"cast(floor({size} / 2) as int)"
        keys.append(f"xxhash64(1, {size}, substring_index(plain, ' ', {half}))")
        keys.append(f"xxhash64(2, {size}, substring_index(plain, ' ', {half} - cast({size} as int)))")
    return [F.when(F.col("n") >= NEAR_WORDS, F.expr(key)) for key in keys]


def _distinct_lines(texts: DataFrame, numbered: DataFrame) -> DataFrame:
    """Every line once: its first place and the hashes of its halves."""
    plain = F.transform(F.split("text", "\n"), lambda line: F.trim(F.regexp_replace(line, BLANKS + "+", " ")))
    lines = texts.join(numbered, "key").select("number", F.posexplode(plain).alias("line", "plain")).filter("plain <> ''")
    lines = lines.withColumn("n", F.length("plain") - F.length(F.replace("plain", F.lit(" "), F.lit(""))) + 1)
    halves = [key.alias(f"half{code}") for code, key in enumerate(_half_keys())]
    lines = lines.select(F.xxhash64("plain").alias("low"), F.xxhash64(F.lit(7), "plain").alias("high"), _place().alias("place"), *halves)
    halves = [f"half{code}" for code in range(_HALVES)]
    # Equal lines have equal halves.
    lines = lines.groupBy("low", "high").agg(F.min("place").alias("place"), *(F.min(half).alias(half) for half in halves))
    # Always true. It names all columns, so that every use of the lines has the same plan and they are made once.
    return lines.filter(F.coalesce(*halves, "place").isNotNull()).select("place", *halves)


def _candidates(lines: DataFrame) -> DataFrame:
    """Places of lines that share a half with another line, with the codes of those halves."""
    halves = F.array(*(F.struct(F.lit(code).alias("code"), F.col(f"half{code}").alias("hash")) for code in range(_HALVES)))
    keys = lines.filter("half0 IS NOT NULL").select("place", F.explode(halves).alias("half")).select("half.hash", "place", "half.code")
    shared = keys.groupBy("hash").agg(F.count("place").alias("n")).filter("n > 1").select("hash")
    return keys.join(shared, "hash", "left_semi").groupBy("place").agg(F.collect_set("code").alias("codes"))


def _lines_of(texts: DataFrame, numbered: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words of the wanted lines, with their place and codes."""
    listed = wanted.groupBy(_number("place").alias("number")).agg(F.collect_list(F.struct("place", "codes")).alias("wanted"))
    found = texts.join(listed.join(numbered, "number"), "key").select(F.split("text", "\n").alias("shown"), F.explode("wanted").alias("of"))
    line = F.pmod("of.place", F.lit(1 << _LINE_BITS)).cast("int")
    found = found.select("of.place", "of.codes", words_of(F.get("shown", line)).alias("words"))
    # Dealt once more, few as they are now, so that texts are not read again for each use. Equal rows are one.
    return found.repartition("place").dropDuplicates(["place"])


def _variants(lines: DataFrame) -> DataFrame:
    """Keys of lines without one word: kind ``S`` if another may stand there, ``D`` if none, ``F`` for a whole line.

    A line's hash is a sum over its words and their positions, twice, so a word
    left out is a difference, and words that move up have sums of their own.
    """
    rows = lines.select("place", "codes", F.size("words").alias("n"), F.posexplode("words").alias("at", "word"))
    part = Window.partitionBy("place")
    before = part.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    # Forty bits a word leave room for lines of eight million words.
    for seed in (1, 2):
        rows = rows.withColumn(f"own{seed}", F.pmod(F.xxhash64(F.lit(seed), "word", "at"), F.lit(1 << 40)))
        rows = rows.withColumn(f"moved{seed}", F.pmod(F.xxhash64(F.lit(seed), "word", F.col("at") - 1), F.lit(1 << 40)))
    sums = {}
    for seed in (1, 2):
        sums[f"whole{seed}"] = F.sum(f"own{seed}").over(part)
        ahead = F.coalesce(F.sum(f"own{seed}").over(before), F.lit(0))
        behind = F.sum(f"moved{seed}").over(part) - F.coalesce(F.sum(f"moved{seed}").over(before), F.lit(0)) - F.col(f"moved{seed}")
        sums[f"without{seed}"] = ahead + behind
    rows = rows.withColumns(sums)

    # Codes 0 and 1 are halves of the line as it is, 2 and 3 as if one word shorter; the edit is in the half not shared.
    middle, shorter = "floor(n / 2)", "floor((n - 1) / 2)"
    same = f"(array_contains(codes, 0) AND at >= {middle}) OR (array_contains(codes, 1) AND at < {middle})"
    longer = f"(array_contains(codes, 2) AND at >= {shorter}) OR (array_contains(codes, 3) AND at <= {shorter})"
    changed = F.when(F.expr(same), F.struct(F.lit("S").alias("kind"), F.xxhash64(F.lit("S"), "n", "at", F.expr("whole1 - own1"), F.expr("whole2 - own2")).alias("variant")))
    dropped = F.when(F.expr(longer), F.struct(F.lit("D").alias("kind"), F.xxhash64(F.lit("D"), F.expr("n - 1"), "without1", "without2").alias("variant")))
    entire = F.when(F.expr("at = 0 AND (array_contains(codes, 0) OR array_contains(codes, 1))"), F.struct(F.lit("F").alias("kind"), F.xxhash64(F.lit("D"), "n", "whole1", "whole2").alias("variant")))
    return rows.select("place", F.explode(F.array_compact(F.array(changed, dropped, entire))).alias("v")).select("place", "v.kind", "v.variant")


def _near(found: DataFrame) -> DataFrame:
    """Places of first lines that have an earlier line one word away."""
    variants = _variants(found)
    least = variants.groupBy("variant").agg(*(F.min(F.when(F.col("kind") == kind, F.col("place"))).alias(f"least_{kind}") for kind in "SDF"))
    # Lines with a changed word are all one apart; a longer line is one apart from the whole one, and the other way round.
    partner = F.when(F.col("kind") == "S", F.col("least_S")).when(F.col("kind") == "D", F.col("least_F")).otherwise(F.col("least_D"))
    pairs = variants.join(least, "variant").select("place", partner.alias("earlier")).filter("earlier < place").distinct()

    # All have codes; naming them makes this the same plan as above.
    words = found.filter("size(codes) > 0").select("place", "words")
    pairs = pairs.join(words.withColumnRenamed("words", "own"), "place")
    # One earlier line may have very many later ones.
    pairs = with_index(pairs, words.select(F.col("place").alias("earlier"), F.col("words").alias("other")), "earlier")
    ahead = "array_position(zip_with({0}, {1}, (x, y) -> x <=> y), false)"
    agreeing = f"({ahead.format('own', 'other')} - 1 + {ahead.format('reverse(own)', 'reverse(other)')} - 1)"
    return pairs.filter(f"{agreeing} >= greatest(size(own), size(other)) - 1").select("place").distinct()


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` as structs ``row``, with the kept ``text``, and the numbers of lines with words: all, equal, near."""
    key = F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    rows = docs.select(key.alias("key"), F.struct(*(F.col(name) for name in docs.columns if name != "text")).alias("row"))
    # Everything that reads texts reads these two columns, so that their exchange is made once.
    texts = docs.select(key.alias("key"), F.col("text").cast("string").alias("text"))
    numbered = _numbered(docs.select(key.alias("key"), F.col("doc_id").cast("bigint").alias("doc_id")))
    lines = _distinct_lines(texts, numbered)
    near = _near(_lines_of(texts, numbered, _candidates(lines))).withColumn("near", F.lit(True))
    firsts = lines.select("place").join(near, "place", "left")
    line = F.pmod("place", F.lit(1 << _LINE_BITS)).cast("int")
    firsts = firsts.groupBy(_number("place").alias("number")).agg(F.collect_set(F.when(F.col("near").isNull(), line)).alias("kept"), F.count("near").alias("n_near"))
    firsts = firsts.join(numbered, "number").drop("number")

    found = texts.join(firsts, "key", "left").select("key", F.split("text", "\n").alias("shown"), F.coalesce("kept", F.array().cast("array<int>")).alias("kept"), F.coalesce("n_near", F.lit(0)).alias("n_near"))
    empty = F.expr(f"filter(transform(shown, (x, i) -> if(x rlike '{BLANKS.replace('[', '[^')}', NULL, i)), i -> i IS NOT NULL)".replace("\\", "\\\\"))
    found = found.withColumn("empty", empty)
    left = F.expr("array_join(transform(sort_array(concat(kept, empty)), i -> get(shown, i)), '\\n')")
    total = F.size("shown") - F.size("empty")
    found = found.select(
        "key",
        F.when(F.col("shown").isNotNull(), left).alias("text"),
        F.when(F.col("shown").isNull(), 0).otherwise(total).cast("bigint").alias("n_lines"),
        F.when(F.col("shown").isNull(), 0).otherwise(total - F.size("kept") - F.col("n_near")).cast("bigint").alias("n_equal"),
        F.col("n_near").cast("bigint").alias("n_near"),
    )
    # Equal rows have one text between them, and each gets it.
    return rows.join(found.dropDuplicates(["key"]), "key").drop("key")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: lines with words, those removed as equal and as near, and a hash of the text left."""
    return cleaned(docs).select(F.col("row.doc_id").cast("bigint").alias("doc_id"), "n_lines", "n_equal", "n_near", F.sha2("text", 256).alias("text_sha256"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with the text left, without documents that lost all their lines.

    A column ``n_chars``, if there is one, follows the text.
    """
    rows = cleaned(docs)
    # Computed before the filter, which would else be pushed below and compute it twice.
    rows = rows.select("row", computed_once([F.col(name) for name in rows.columns if name != "row"]))
    rows = rows.filter("n_lines = 0 OR n_lines > n_equal + n_near")
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return rows.select(*(changed[name].alias(name) if name in changed else F.col("row")[name].alias(name) for name in docs.columns))


def sql(documents: str) -> str:
    """The same report in DuckDB, by joining the variants of all lines."""
    words = f"regexp_extract_all(shown, '{PLAIN_WORD}')"
    return f"""
    WITH shown AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS shown, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM ({documents}) AS source),
    lines AS MATERIALIZED (SELECT doc_id, line, {words} AS words, array_to_string({words}, ' ') AS plain FROM shown WHERE len({words}) > 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY plain ORDER BY doc_id, line) AS rank FROM lines),
    firsts AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id, line) AS place, doc_id, line, words, plain FROM ranked WHERE rank = 1),
    long AS (SELECT * FROM firsts WHERE len(words) >= {NEAR_WORDS}),
    variants AS MATERIALIZED (
        SELECT place, i, len(words) AS n, array_to_string(words[1:i - 1], ' ') || ' ' || array_to_string(words[i + 1:], ' ') AS rest
        FROM long, unnest(range(1, len(words) + 1)) AS t(i)),
    near AS (
        SELECT b.place FROM variants AS a JOIN variants AS b USING (i, n, rest) WHERE a.place < b.place
        UNION SELECT greatest(v.place, l.place) FROM variants AS v JOIN long AS l ON trim(v.rest) = l.plain AND len(l.words) = v.n - 1),
    judged AS (
        SELECT s.doc_id, s.line, s.shown, l.line IS NOT NULL AS worded, r.rank > 1 AS equal, coalesce(r.rank = 1 AND f.place IN (SELECT place FROM near), false) AS near
        FROM shown AS s LEFT JOIN lines AS l USING (doc_id, line) LEFT JOIN ranked AS r USING (doc_id, line) LEFT JOIN firsts AS f USING (doc_id, line)),
    left_ AS (
        SELECT doc_id, count(*) FILTER (worded) AS n_lines, count(*) FILTER (equal) AS n_equal, count(*) FILTER (near) AS n_near,
               coalesce(string_agg(shown, chr(10) ORDER BY line) FILTER (NOT coalesce(equal, false) AND NOT near), '') AS text FROM judged GROUP BY doc_id)
    SELECT source.* EXCLUDE (text), n_lines, n_equal, n_near, left_.text AS text FROM ({documents}) AS source JOIN left_ USING (doc_id)"""


QUERY_SQL = f"SELECT doc_id, n_lines, n_equal, n_near, sha256(text) AS text_sha256 FROM ({sql('SELECT * FROM documents')}) AS report"

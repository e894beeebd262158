"""Phrase collocation mining by top-order marginalisation.

Every word occurrence gives one window: the word and its lead words up to the longest phrase, padded
with nulls where its piece of text ends. Only these longest windows are counted over the texts. A
``ROLLUP`` over the counted windows then sums them by ever shorter prefixes: the prefix of two words of
all windows is every pair of neighbours, the prefix of one word is every word, and the empty prefix is
the number of words. No shorter n-gram is ever taken from a text.

Most long windows occur once, so a sieve goes ahead of the count. Prefixes are counted by their 64-bit hash
alone, and what is frequent sets a bit of a bitmap. A lead word whose prefix has no bit becomes padding: its
phrase is not frequent, and the shorter prefixes keep their sums. Hashes and bits that collide let a
phrase through, no more; all that is returned is counted by its words.

Only phrases with ``least`` occurrences go on. The parts into which a frequent phrase is cut are frequent
themselves, so all look-ups stay among them. Products are decimals of 38 digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortflow.llm.common import pick, read, small
from cohortflow.session import stage

LONGEST = 3
LEAST = 10
#: A phrase goes if a longer one around it has this percentage of its occurrences.
COVERED = 50
TOP = 2000
NO_LANG = "und"
#: What ends a piece of text, and what parts words within a piece; the first of each stands for the others.
PIECE_ENDS, BLANKS = ".,;:!?\n\x0b\x0c\r", " \t"
#: Bits of the sieve per frequent prefix; 64-bit numbers of the sieve, at least and at most; numbers in a row of it.
SIEVE_BITS, SIEVE_NUMBERS, SIEVE_ROW = 16, (1 << 10, 1 << 23), 1 << 10
#: Candidates of a language that one task ranks, about; parts of a language, at least.
RANKED_ROWS, RANKED_PARTS = 200_000, 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def windows(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``lang, w1, .. w<longest>`` per word occurrence: the word and its lead words, null behind the piece's end."""
    rows = pick(docs, "text", "lang")
    lang = F.coalesce(F.col("lang"), F.lit(NO_LANG)).alias("lang")
    # One translation, so that both splits are by one plain character.
    plain = F.translate(
        "text", _UPPER + PIECE_ENDS[1:] + BLANKS[1:], _LOWER + PIECE_ENDS[0] * len(PIECE_ENDS[1:]) + BLANKS[0] * len(BLANKS[1:])
    )
    rows = rows.select(lang, F.explode(F.split(plain, r"\.")).alias("piece"))
    rows = rows.select("lang", F.array_remove(F.split("piece", BLANKS[0]), "").alias("w"))
    # Lead columns: the words moved up by 0, 1, ..; arrays_zip pads the shorter ones with nulls.
    leads = [F.slice("w", i + 1, F.size("w")).alias(f"w{i + 1}") for i in range(longest)]
    return rows.where(F.size("w") > 0).select("lang", F.inline(F.arrays_zip(*leads)))


def _prefix_hash(words: int) -> Column:
    """Hash of a window's first ``words`` words and its language; null where it is padded."""
    last = F.col(f"w{words}")
    return F.when(last.isNotNull(), F.xxhash64("lang", *[f"w{i + 1}" for i in range(words)]))


def sieve(rows: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, int]:
    """A written table ``row, bits`` (``array<bigint>``) with a bit for every prefix hash held ``least`` times, and its numbers.

    The size follows the count of such hashes up to a bound; beyond it bits are shared more often.
    """
    hashes = [_prefix_hash(m) for m in range(2, longest + 1)]
    held = rows.select(F.stack(F.lit(len(hashes)), *hashes).alias("h")).where("h IS NOT NULL").groupBy("h").count()
    frequent = stage(held.where(F.col("count") >= least).select("h"), "phrases-frequent")
    wanted = frequent.count() * SIEVE_BITS // 64
    numbers = min(max(1 << wanted.bit_length(), SIEVE_NUMBERS[0]), SIEVE_NUMBERS[1])
    place = frequent.select(F.pmod("h", F.lit(64 * numbers)).alias("x"))
    marked = place.select(F.expr("shiftright(x, 6) AS number"), F.expr("shiftleft(1L, CAST(x & 63 AS INT)) AS bit"))
    none = rows.sparkSession.range(numbers).select(F.col("id").alias("number"), F.lit(0).cast("long").alias("bit"))
    each = marked.unionByName(none).groupBy("number").agg(F.bit_or("bit").alias("bit"))
    in_order = F.sort_array(F.collect_list(F.struct("number", "bit")))
    table = each.groupBy(F.expr(f"number div {SIEVE_ROW}").alias("row")).agg(in_order.alias("all"))
    return stage(table.select("row", F.col("all.bit").alias("bits")), "phrases-sieve"), numbers


def sieved(rows: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """The windows, padded from the first lead word on whose prefix is not frequent."""
    table, numbers = sieve(rows, longest, least)
    for m in range(2, longest + 1):
        x = F.pmod(_prefix_hash(m), F.lit(64 * numbers))
        # 64 MB at most: SIEVE_NUMBERS.
        rows = rows.withColumn("x", x).withColumn("row", F.expr(f"shiftright(x, 6) div {SIEVE_ROW}"))
        rows = rows.join(F.broadcast(table), "row", "left")
        bit = F.expr(f"(shiftright(bits[CAST(shiftright(x, 6) % {SIEVE_ROW} AS INT)], CAST(x & 63 AS INT)) & 1) = 1")
        rows = rows.withColumn(f"w{m}", F.when(bit, F.col(f"w{m}"))).drop("x", "row", "bits")
    return rows


def counted(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Two written tables: ``lang, words, a`` of phrases of up to ``longest`` words, and ``lang, n``."""
    columns = [f"w{i + 1}" for i in range(longest)]
    top = sieved(windows(docs, longest), longest, least).groupBy("lang", *columns).agg(F.count(F.lit(1)).alias("held"))
    summed = top.rollup("lang", *columns).agg(F.sum("held").alias("a"), F.grouping_id().alias("level"))
    # Bits of the level name the columns that a sum runs over, the last column first.
    open_ = F.lit(longest) - F.bit_count("level")
    words = F.slice(F.array(*columns), 1, F.greatest(F.lit(0), open_))
    # A padded prefix stands for no phrase.
    frequent = (F.col("a") >= least) & F.forall(words, lambda w: w.isNotNull())
    frequent = summed.where("lang IS NOT NULL").where(frequent | (open_ == 0))
    found = stage(frequent.select("lang", words.alias("words"), "a"), "phrases-found")
    sizes = found.where("size(words) = 0").select("lang", F.col("a").alias("n"))
    return found.where("size(words) > 0"), sizes


def scored(found: DataFrame) -> DataFrame:
    """``lang, words, a, l, r, score`` of the phrases of two words or more: their lowest-scoring cut."""
    cuts = F.expr(
        "transform(sequence(1, size(words) - 1), k ->"
        " struct(k, slice(words, 1, k) AS first, slice(words, k + 1, size(words)) AS rest))"
    )
    cut = found.where("size(words) > 1").select("lang", "words", "a", F.explode(cuts).alias("c"))
    cut = cut.select("lang", "words", "a", "c.*")
    rows = found.count()
    for part, name in (("first", "l"), ("rest", "r")):
        side = found.select("lang", F.col("words").alias(part), F.col("a").alias(name))
        cut = cut.join(small(side, rows), ["lang", part]).drop(part)
    lowest = F.min(F.struct(_score("a", "l", "r").alias("score"), "k", "l", "r")).alias("lowest")
    scores = cut.groupBy("lang", "words", "a").agg(lowest)
    return scores.select("lang", "words", "a", "lowest.l", "lowest.r", "lowest.score")


def _score(a: str, left: str, right: str) -> Column:
    wide = "DECIMAL(19, 0)"
    return F.expr(
        f"CAST(1000000 * (CAST({a} AS {wide}) * CAST({a} AS {wide})) AS DECIMAL(38, 0))"
        f" div (CAST({left} AS {wide}) * CAST({right} AS {wide}))"
    )


def uncovered(scores: DataFrame, covered: int = COVERED) -> DataFrame:
    """The phrases that no longer one covers; longer ones count whether they are covered themselves or not."""
    inner = F.expr(
        "flatten(transform(sequence(2, size(words) - 1), m ->"
        " transform(sequence(1, size(words) - m + 1), i -> slice(words, i, m))))"
    )
    around = scores.where("size(words) > 2").select("lang", F.explode(inner).alias("words"), "a")
    around = around.groupBy("lang", "words").agg(F.max("a").alias("around"))
    kept = scores.join(around, ["lang", "words"], "left")
    return kept.where(F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * covered)).drop("around")


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, covered: int = COVERED, top: int = TOP
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of every language.

    Null, empty and blank texts hold no words; a null language is ``und``. Repeated rows count as often
    as they occur. Ties in score go by occurrences, then by the phrase in byte order, so the ranks are
    the same in every run. A language without candidates has no rows, and an empty table gives none.
    """
    found, sizes = counted(docs, longest, least)
    kept = uncovered(stage(scored(found), "phrases-scored"), covered)
    kept = kept.select("lang", F.array_join("words", " ").alias("phrase"), "a", "l", "r", "score")
    kept = stage(kept, "phrases-kept")
    # Ranked in two steps, so that a language of any size is cut before it comes together.
    salts = max(RANKED_PARTS, kept.count() // RANKED_ROWS)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(salts)).alias("salt")
    part = F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))
    first = kept.select("*", salt).withColumn("rank", part).where(F.col("rank") <= top).drop("salt", "rank")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long").alias("rank")
    ranked = first.select("*", rank).where(F.col("rank") <= top)
    ranked = ranked.join(small(sizes, sizes.count()), "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of two or three words of every language."""
    return collocations(read(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i : i + m - 1])) AS words
  FROM w, (VALUES (1), (2), (3)) AS v(m) WHERE len(w) >= m),
c AS MATERIALIZED (SELECT lang, words, count(*) AS a FROM g GROUP BY lang, words HAVING count(*) >= 10),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
k AS (SELECT lang, words, a, k, words[1:k] AS first, words[k + 1:] AS rest FROM c, (VALUES (1), (2)) AS v(k) WHERE k < len(words)),
x AS MATERIALIZED (SELECT k.*, c.a AS l FROM k JOIN c ON k.lang = c.lang AND k.first = c.words),
y AS (SELECT x.*, c.a AS r, (1000000::HUGEINT * x.a * x.a) // (x.l::HUGEINT * c.a) AS score FROM x JOIN c ON x.lang = c.lang AND x.rest = c.words),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, words ORDER BY score, k) AS place FROM y),
o AS (SELECT lang, words, max(a) AS around FROM (SELECT lang, words[1:2] AS words, a FROM c WHERE len(words) = 3
  UNION ALL SELECT lang, words[2:3], a FROM c WHERE len(words) = 3) GROUP BY ALL),
s AS (SELECT b.* FROM b LEFT JOIN o ON b.lang = o.lang AND b.words = o.words
  WHERE place = 1 AND NOT coalesce(len(b.words) = 2 AND 100 * around >= 50 * b.a, false)),
r AS (SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, CAST(score AS BIGINT) AS score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank FROM s)
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= 2000
"""

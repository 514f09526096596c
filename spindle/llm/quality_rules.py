"""Quality rules by distribution divergence, in DataFrame functions only.

Each text gives two histograms: of character classes, and of common words of
some languages (a share goes to all other words).  The reference of a
language sums the histograms of all its documents.  A document fails if its
Jensen-Shannon distance to the reference of its language is over a limit,
for characters or for words; each test has a guard, the fewest characters or
words that it applies to.  Base counts come with it: words, symbols,
repeated lines, and words in three-word windows that occur again.

One pass makes the counts; they are written, summed for the references and
judged.  Windows are compared by 64-bit hashes within a text; the positions
of repeated windows are sorted only in texts that have any, so the cost of a
text is n log n.  No text is exploded into rows.

References are a table, joined by language; the planner broadcasts it if it
is small.

Edge cases: null text has no words; text without words fails the base rule
and no other.  A document without a language is judged against all those with
one together.  Languages with under ``REFERENCE_CHARS`` characters in all give no
reference, and only the base rule fails their documents.  Repeated rows get
equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm import oracles
from spindle.llm.common import cut, documents
from spindle.llm.registry import query

SPACE = r"[\x20\x09-\x0D]+"
# Character classes (the rest of a text is the class "other"), and common words as they are written.
CHARACTERS = {"lower": "[a-z]+", "space": SPACE, "mark": r"[.,;:!?'\"()-]+", "upper": "[A-Z]+", "symbol": "[#*$%&|<>]+", "digit": "[0-9]+"}
COMMON = "the of and to in that der die und das ist von le la les et que une el los del por con una".split()

CHAR_LIMIT, WORD_LIMIT = 0.28, 0.45
CHAR_GUARD, WORD_GUARD = 100, 50
#: Characters from which a language has a reference.
REFERENCE_CHARS = 2_000


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))


def covered_words(windows: Column, few: int = 64) -> Column:
    """Words in windows of three whose hash is there twice or more.

    Sorted hashes show which are repeated.  Their places are found by looking
    each window up, if they are ``few``, or else by sorting hash and place
    together; in order, a place covers three words, or as many as there are
    up to the next."""
    def again(hashes: Column) -> Column:
        return F.array_distinct(F.filter(hashes, lambda h, i: F.coalesce(h == F.get(hashes, i + 1), F.lit(False))))

    def neighbours(pairs: Column) -> Column:
        same = lambda x, other: F.coalesce(x["h"] == F.get(pairs, other)["h"], F.lit(False))
        return F.transform(F.filter(pairs, lambda x, i: F.when(i > 0, same(x, i - 1)).otherwise(F.lit(False)) | same(x, i + 1)), lambda x: x["i"])

    def places(repeated: Column) -> Column:
        pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        looked_up = F.filter(F.transform(windows, lambda h, i: F.when(F.array_contains(repeated, h), i)), lambda i: i.isNotNull())
        return F.when(F.size(repeated) <= few, looked_up).otherwise(F.sort_array(let(F.sort_array(pairs), neighbours)))

    def cover(at: Column) -> Column:
        return _sum(F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3)))))

    return let(let(let(F.sort_array(windows), again), places), cover)


def counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang and all counts of each text; one pass, no shuffle.

    Character classes are taken out of the text one after another, the
    largest first, so each pass reads only what the ones before left."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    inner = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE))
    base = docs.select("doc_id", lang.alias("lang"), text.alias("left_0"), words.alias("words"))
    lines = F.filter(F.split("left_0", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    window = lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))
    n = F.size("words")
    base = base.select(
        "doc_id", "lang", "left_0", n.cast("bigint").alias("n_words"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        F.transform(F.slice("words", 1, F.greatest(n - 2, F.lit(0))), window).alias("windows"),
        F.filter("words", lambda w: w.isin(COMMON)).alias("common"))
    for k, pattern in enumerate(CHARACTERS.values()):
        base = base.withColumn(f"left_{k + 1}", F.regexp_replace(f"left_{k}", pattern, ""))
    sizes = [F.length(f"left_{k}").cast("bigint") for k in range(len(CHARACTERS) + 1)]
    taken = {c: sizes[k] - sizes[k + 1] for k, c in enumerate(CHARACTERS)}
    different = F.size(F.array_distinct("windows"))
    repeated = F.when(different < F.size("windows"), covered_words(F.col("windows"))).otherwise(F.lit(0))
    known = [(F.size("common") - F.size(F.array_remove("common", w))).cast("bigint") for w in COMMON]
    return base.select(
        "doc_id", "lang", sizes[0].alias("n_chars"), "n_words", (sizes[0] - taken["space"]).alias("word_chars"),
        taken["symbol"].alias("n_symbols"), "n_dup_lines", repeated.cast("bigint").alias("n_repeat_words"),
        F.array(*taken.values(), sizes[-1]).alias("chars"), F.array(*known, F.col("n_words") - F.size("common")).alias("words"))


def references(counted: DataFrame, least_chars: int = REFERENCE_CHARS) -> DataFrame:
    """lang and the shares of its classes and words (ref_chars, ref_words),
    and a row of all documents with a language together (lang null)."""
    added = lambda name, n: F.array(*[F.sum(F.get(name, F.lit(k))) for k in range(n)]).alias(name)
    sums = counted.groupBy("lang").agg(added("chars", len(CHARACTERS) + 1), added("words", len(COMMON) + 1))
    named = sums.filter(F.col("lang").isNotNull())
    together = named.select(F.lit(None).cast(counted.schema["lang"].dataType).alias("lang"), added("chars", len(CHARACTERS) + 1), added("words", len(COMMON) + 1))
    both = named.union(together).filter(_sum(F.col("chars")) >= least_chars)
    share = lambda c: let(_sum(F.col(c)), lambda n: F.transform(c, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0)))).alias(f"ref_{c}")
    return both.select("lang", share("chars"), share("words"))


def divergence(shares: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2) of a histogram and a reference."""
    def toward(p: Column, middle: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / middle)).otherwise(F.lit(0.0))

    parts = F.zip_with(shares, reference, lambda p, q: toward(p, (p + q) / 2) + toward(q, (p + q) / 2))
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def distance(histogram: str, size: str) -> Column:
    """Distance to the reference; 0 without one, or for an empty text."""
    shares = F.transform(histogram, lambda x: x / F.col(size))
    reference = F.col(f"ref_{histogram}")
    return F.when((F.col(size) > 0) & reference.isNotNull(), divergence(shares, reference)).otherwise(F.lit(0.0))


def judge(docs: DataFrame, *, char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT, char_guard: int = CHAR_GUARD,
          word_guard: int = WORD_GUARD) -> DataFrame:
    """Counts, distances and the verdict of each document."""
    counted = cut(counts(docs), "quality-counts")
    known = cut(references(counted), "quality-references")
    doc, ref = counted.alias("d"), known.alias("r")
    told = doc.join(ref, F.col("d.lang").eqNullSafe(F.col("r.lang")), "left").select("d.*", "ref_chars", "ref_words")
    far = told.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars",
        distance("chars", "n_chars").alias("char_distance"), distance("words", "n_words").alias("word_distance"))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    odd = ((F.col("n_chars") >= char_guard) & (F.col("char_distance") > char_limit)) | ((F.col("n_words") >= word_guard) & (F.col("word_distance") > word_limit))
    return far.withColumn("base_failed", base).withColumn("kept", ~base & ~odd).drop("n_chars")


@query("op9_quality_rules", oracles.QUALITY_RULES)
def op9_quality_rules(spark, sf_dir):
    return judge(documents(spark, sf_dir)).drop("char_distance", "word_distance")

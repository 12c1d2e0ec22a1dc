"""Spelling variant grouping: words that are one edit apart, found by asymmetric q-chunks.

Of a pair of words the shorter one (of equal lengths the smaller) contributes two disjoint chunks, its halves; the
other contributes all positional grams that are as long as a half of its own length or of one code point less. One
edit touches at most one of the halves, so the other is a gram of the longer word, and its place shifts by one at
most: by nothing left of the edit, by the difference of the lengths right of it. Chunks and grams are joined on
text, place and length with that shift, and the pairs are verified by their edit distance.

Every word is filed under a handful of keys. A common half makes a large key: its rows are two plain exchanges into
the join, which AQE splits, and pairs are verified where they arise, so only near pairs are shuffled again.

A word's form is its near word of the largest count, where that is at least twice its own. Counts at least double
along a chain of forms, so chains are short; roots are found by pointer jumping over written tables.

Defined results: a null or empty text has no words, a null id changes none; equal rows count as often as they are
given; a long text is read whole; ties between forms go to the smaller word in code-point order; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.storage import forget, written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RUN = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH = 5
MIN_COUNT = 3
TYPO_EVERY = 97


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and every lower-cased letter run of its text, one row each."""
    words = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, UPPER.lower()), F.lit(f"({RUN})"))
    return docs.select(F.col(id_col).alias("doc_id"), F.explode(words).alias("run"))


def with_typos(run_rows: DataFrame, every: int = TYPO_EVERY) -> DataFrame:
    """``word``: the run, without one code point where ``every`` divides the hash of id and run."""
    h = F.crc32(F.concat_ws(":", F.col("doc_id").cast("string"), "run").cast("binary"))
    at = F.pmod(h, F.char_length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr(F.col("run"), at + 2))
    changed = F.col("doc_id").isNotNull() & (F.pmod(h, F.lit(every)) == 0)
    return run_rows.select(F.when(changed, shorter).otherwise(F.col("run")).alias("word"))


def word_counts(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word``, ``n`` of the words that are long and frequent enough; counted per task before the shuffle."""
    return (words.filter(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= min_count))


def chunks(words: DataFrame) -> DataFrame:
    """The two halves of every word, each at its place in a partner as long (``equal``) or one code point longer.

    ``head`` and ``tail`` are the word, cut in the middle of its other half: one of them survives the edit too."""
    size = F.char_length("word")
    half = (size / 2).cast("int")
    first, second = F.substr("word", F.lit(1), half), F.substr(F.col("word"), half + 1)
    keys = F.array(*[F.struct(gram.alias("gram"), (place + shift).alias("place"), (size + more).alias("size"),
                              F.lit(more == 0).alias("equal"), cut.alias("cut"))
                     for more in (0, 1)
                     for gram, place, shift, cut in ((first, F.lit(0), 0, half + ((size - half) / 2).cast("int")),
                                                     (second, half, more, (half / 2).cast("int")))])
    cut = F.col("k.cut")
    return words.select("word", F.col("n").alias("short_n"), F.explode(keys).alias("k")).select(
        "short_n", "k.gram", "k.place", "k.size", "k.equal",
        F.substr("word", F.lit(1), cut).alias("head"), F.substr(F.col("word"), cut + 1).alias("tail"))


def grams(words: DataFrame) -> DataFrame:
    """All positional grams of every word, of the lengths that halves of its partners have."""
    size = F.char_length("word")
    half = (size / 2).cast("int")
    lengths = F.array_distinct(F.array(half, size - half, ((size - 1) / 2).cast("int"), size - 1 - ((size - 1) / 2).cast("int")))
    sized = words.select(F.col("word").alias("long"), F.col("n").alias("long_n"), size.alias("size"), F.explode(lengths).alias("q"))
    placed = sized.select("long", "long_n", "size", "q", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("q"))).alias("place"))
    return placed.select("long", "long_n", F.substr(F.col("long"), F.col("place") + 1, F.col("q")).alias("gram"), "place", "size")


def near_pairs(words: DataFrame) -> DataFrame:
    """``short``, ``short_n``, ``long``, ``long_n``: every pair of ``words`` (word, n) at one edit, once."""
    short = F.concat("head", "tail")
    survives = F.col("long").startswith(F.col("head")) | F.col("long").endswith(F.col("tail"))
    once = ~F.col("equal") | (short < F.col("long"))
    met = chunks(words).hint("merge").join(grams(words), ["gram", "place", "size"])
    found = met.filter(survives & once & (F.levenshtein(short, "long", 1) == 1))
    return found.select(short.alias("short"), "short_n", "long", "long_n").distinct()


def forms(words: DataFrame, pairs: DataFrame, ratio: int = 2) -> DataFrame:
    """``word``, ``n_near``, and ``form`` with ``form_n`` for the words that have near ones."""
    one = pairs.select(F.col("short").alias("word"), F.col("short_n").alias("n"), F.col("long").alias("near"), F.col("long_n").alias("near_n"))
    other = pairs.select(F.col("long").alias("word"), F.col("long_n").alias("n"), F.col("short").alias("near"), F.col("short_n").alias("near_n"))
    best = (one.unionByName(other).groupBy("word", "n")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")))
    good = -F.col("best.minus") >= ratio * F.col("n")
    return best.select("word", "n_near", F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.minus")).alias("form_n"))


def roots(forms_table: DataFrame) -> DataFrame:
    """``word``, ``root`` for the words with a form: pointers are doubled until none moves."""
    at = written(forms_table.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        after = at.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = written(at.join(after, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        forget(at)
        at = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo_every: int = TYPO_EVERY,
                      min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = 2) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word; ``typo_every`` 0 reads runs as they are."""
    rows = runs(docs, id_col, text_col)
    words = with_typos(rows, typo_every) if typo_every else rows.select(F.col("run").alias("word"))
    words = written(word_counts(words, min_length, min_count), "words")
    linked = written(forms(words, near_pairs(words), ratio), "forms")
    out = words.join(linked, "word", "left").join(roots(linked), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("form_n").cast("long").alias("form_n"))

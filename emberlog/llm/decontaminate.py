"""Benchmark decontamination by winnowing, with DataFrame functions only.

A window is ``SPAN`` consecutive words of a benchmark item; an item of fewer words is one window as a whole. Documents and
items keep the least hash of every ``SPAN - GRAM + 1`` consecutive word k-grams (all of them where equal), so two texts
that share ``SPAN`` words share a kept k-gram at the same place of the span. The fingerprints are joined on their
hash, and each hit is extended word by word to both sides by as much as a window can reach; it counts where the equal
stretch is as long as a window. So a hit is decided by the words, not by hashes, and none is missed. Short items are
looked for by the hash of all their words; one reading of the documents serves all lengths that occur.

Words are runs of letters, digits and characters beyond ASCII, with A-Z in lower case. A null or empty text has no words
and is clean. Items without words have no window. Documents are told apart by id and text, so rows with equal ids
are judged by their own text, and repeated rows each get the same answer. A null item id is left out of the lists but its
windows count. An empty table of documents or of items gives the obvious result. Other columns of documents are
handed on, whatever their names, but for those that bear the name of a result (n_words, n_hit, items): these are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.shared import ascii_lower, sealed, small_enough, unsealed

SPAN, GRAM = 10, 5
#: The k-grams of windows of full length, and how many of them a window has.
LONG = (GRAM, SPAN - GRAM + 1)


def _run_without(*ranges: tuple[int, int]) -> str:
    """A run of characters outside of ranges. They are listed one by one, which Java looks up in one step per character."""
    return "[^" + "".join(f"\\x{code:02X}" for first, last in ranges for code in range(first, last + 1)) + "]+"


WORD = _run_without((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: The same with A-Z, for counting words without lower-casing them.
ANY_CASE_WORD = _run_without((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
#: The benchmark side of a join is broadcast up to so many rows of at most 2 * SPAN words.
BROADCAST_WINDOWS = 100_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def with_column_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a column that is computed once per row, however often lambdas refer to it later."""
    return df.select("*", F.explode(F.array(column)).alias(name))


def upto(last: Column) -> Column:
    """0, 1, ... last; empty where last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def fingerprints(df: DataFrame, words: str, schemes: list[tuple[int, int]]) -> DataFrame:
    """Explode each row into its kept k-grams: ``gram``, ``width``, ``at`` (first word) and ``print`` (hash).

    A scheme is a pair of ``gram`` and ``width``, the k-grams in a window. Texts are split and hashed once for all schemes; of a
    text one scheme's arrays are held at a time.
    """
    df = with_column_once(df, "hashes", F.transform(words, lambda word: F.xxhash64(word)))
    listed = F.array(*(F.struct(F.lit(g).alias("gram"), F.lit(w).alias("width")) for g, w in schemes))
    # A text shorter than a window has no window, so nothing to keep.
    df = df.select("*", F.inline(listed)).filter(F.size("hashes") >= F.col("gram") + F.col("width") - 1)

    def hashed(gram: int, width: int) -> Column:
        return F.transform(
            upto(F.size("hashes") - gram),
            lambda i: F.xxhash64(F.lit(gram), F.lit(width), *(F.get("hashes", i + k) for k in range(gram))),
        )

    of_scheme = [F.when((F.col("gram") == g) & (F.col("width") == w), hashed(g, w)) for g, w in schemes]
    df = with_column_once(df, "grams", F.coalesce(*of_scheme)).drop("hashes")

    def chosen(width: int) -> Column:
        def kept(i: Column) -> Column:
            return F.get("grams", i) == F.greatest(*(F.get("least", i - k) for k in range(width)))

        places = upto(F.size("grams") - 1)
        places = F.filter(places, kept) if width > 1 else places
        return F.transform(places, lambda i: F.struct(i.alias("at"), F.get("grams", i).alias("print")))

    def least(width: int) -> Column:
        return F.transform(
            upto(F.size("grams") - width), lambda i: F.least(*(F.get("grams", i + k) for k in range(width)))
        )

    wide = sorted({w for _, w in schemes if w > 1})
    by_width = [F.when(F.col("width") == w, least(w)) for w in wide]
    df = with_column_once(df, "least", F.coalesce(*by_width, F.array().cast("array<bigint>")))
    by_width = [F.when(F.col("width") == w, chosen(w)) for w in wide]
    return df.select("*", F.inline(F.coalesce(*by_width, chosen(1)))).drop("grams", "least")


def around(words: str, at: Column, gram: Column, reach: Column) -> Column:
    """The k-gram's words with ``reach`` words on each side, null beyond the ends."""
    return F.transform(F.sequence(at - reach, at + gram + reach - 1), lambda i: F.get(words, i))


def benchmark_windows(items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[int]]:
    """(print, gram, context, item) of all items, and the lengths of those shorter than a window."""
    split = with_column_once(
        items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")), "words", words_of(F.col("text"))
    ).drop("text")
    short = [row.n for row in split.select(F.size("words").alias("n")).filter(f"n > 0 AND n < {SPAN}").distinct().collect()]
    # An item that is long enough for windows has no use for the schemes of short ones.
    long = fingerprints(split.filter(F.size("words") >= SPAN), "words", [LONG])
    parts = [long]
    if short:
        own = fingerprints(split.filter(F.size("words") < SPAN), "words", [(n, 1) for n in sorted(short)])
        parts.append(own.filter(F.size("words") == F.col("gram")))
    windows = reduce(DataFrame.unionByName, parts)
    context = around("words", F.col("at"), F.col("gram"), F.col("width") - 1)
    return windows.select("print", context.alias("context"), "item"), sorted(short)


def hits(
    docs: DataFrame, items: DataFrame, doc_cols: tuple[str, str] = ("doc_id", "text"),
    item_cols: tuple[str, str] = ("item_id", "text"),
) -> tuple[DataFrame, DataFrame]:
    """Stretches of documents that lie in benchmark windows, and the windows' items.

    The first table has (id, mark, context_id, start, end) in words, the second (context_id, item). ``mark`` is a hash of the
    document's text.
    """
    windows, short = benchmark_windows(items, *item_cols)
    windows = windows.withColumn("context_id", F.xxhash64("context"))
    contexts = windows.select("print", "context_id", "context").distinct()
    hint = F.broadcast if small_enough(contexts, BROADCAST_WINDOWS) else (lambda df: df)
    keyed = docs.select(F.col(doc_cols[0]).alias("id"), F.col(doc_cols[1]).alias("text")).filter("text IS NOT NULL")
    keyed = keyed.withColumn("mark", F.xxhash64("text"))
    split = with_column_once(keyed, "words", words_of(F.col("text"))).drop("text")
    found = fingerprints(split, "words", [LONG, *((n, 1) for n in short)])
    candidates = found.select("id", "mark", "gram", "width", "at", "print").join(
        hint(contexts.select("print").distinct()), "print", "left_semi"
    )
    # Each candidate's words come from a second reading of the documents that have any. A document lists its places, which
    # are no more than its words for each scheme, however many windows share their hash.
    per_doc = candidates.groupBy(F.col("id").alias("c_id"), F.col("mark").alias("c_mark")).agg(
        F.collect_set(F.struct("gram", "width", "at", "print")).alias("candidates")
    )
    joined = keyed.join(per_doc, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("mark") == F.col("c_mark")))
    joined = with_column_once(joined, "words", words_of(F.col("text")))
    # Only the words that a window can reach travel with a candidate.
    reached = F.transform(
        "candidates",
        lambda c: F.struct(
            c["gram"].alias("gram"), (c["width"] - 1).alias("side"), c["at"].alias("at"), c["print"].alias("print"),
            around("words", c["at"], c["gram"], c["width"] - 1).alias("near"),
        ),
    )
    placed = joined.select("id", "mark", F.inline(reached))
    both = placed.join(hint(contexts), "print").filter(F.size("near") == F.size("context"))

    def same(k: Column) -> Column:
        return F.coalesce(F.get("context", k) == F.get("near", k), F.lit(False))

    both = with_column_once(both, "equal", F.transform(upto(F.size("context") - 1), same)).drop("near", "context")
    # Differences just before and just behind the stretch around the k-gram.
    before = F.coalesce(
        F.array_max(F.filter(upto(F.col("side") - 1), lambda k: ~F.get("equal", k))) + 1, F.lit(0)
    )
    behind = F.coalesce(
        F.array_min(F.filter(upto(F.size("equal") - 1), lambda k: (k >= F.col("side")) & ~F.get("equal", k))),
        F.size("equal"),
    )
    ranged = both.select(
        "id", "mark", "context_id",
        (F.col("at") - F.col("side") + before).alias("start"),
        (F.col("at") - F.col("side") + behind - 1).alias("end"),
        F.when(F.col("side") > 0, SPAN).otherwise(F.col("gram")).alias("least"),
    )
    valid = ranged.filter("end - start + 1 >= least").drop("least")
    return valid, windows.select("context_id", "item").distinct()


def decontaminated(
    docs: DataFrame, items: DataFrame, doc_cols: tuple[str, str] = ("doc_id", "text"),
    item_cols: tuple[str, str] = ("item_id", "text"),
) -> DataFrame:
    """The documents with all their columns and n_words, n_hit, items (sorted array of strings); see the module."""
    id_col, text_col = doc_cols
    valid, owners = hits(docs, items, doc_cols, item_cols)
    key = ["id", "mark"]
    # Windows of many items may cover the same stretch.
    stretches = valid.select(*key, "start", "end").distinct()
    words = stretches.select(*key, F.explode(F.sequence("start", "end")).alias("word")).distinct()
    counted = words.groupBy(*key).agg(F.count("*").alias("n_hit"))
    hint = F.broadcast if small_enough(owners, BROADCAST_WINDOWS) else (lambda df: df)
    named = valid.select(*key, "context_id").distinct().join(hint(owners), "context_id")
    listed = named.groupBy(*key).agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    found = counted.join(listed.select(F.col("id").alias("l_id"), F.col("mark").alias("l_mark"), "items"),
                         F.col("id").eqNullSafe(F.col("l_id")) & (F.col("mark") == F.col("l_mark")))
    found = found.select(F.col("id").alias("_id"), F.col("mark").alias("_mark"), "n_hit", "items")
    found = found.withColumnsRenamed({"n_hit": "_n_hit", "items": "_items"})
    text = F.coalesce("sealed_text", F.lit(""))
    rows = sealed(docs, id_col, text_col).withColumn("_doc_mark", F.xxhash64("sealed_text"))
    joined = rows.join(found, F.col("sealed_id").eqNullSafe(F.col("_id")) & (F.col("_doc_mark") == F.col("_mark")), "left")
    return joined.select(
        *unsealed([c for c in docs.columns if c not in ("n_words", "n_hit", "items")], id_col, text_col),
        F.regexp_count(text, F.lit(ANY_CASE_WORD)).cast("bigint").alias("n_words"),
        F.coalesce("_n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("_items", F.array().cast("array<string>")).alias("items"),
    )

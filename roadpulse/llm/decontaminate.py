"""Benchmark decontamination with built-in functions only.

The windows of the benchmark are hashed and broadcast; each position of each document looks its hash
up, and a hit is verified against the words of the window. Documents are tokenised once, and only
hits and one row per document are shuffled.

Nulls: a null text has no words, a null item likewise. Rows that repeat an id and its text each get
the same result. Extra columns of either table are kept out of the way and given back; names that
begin with two underscores are reserved.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: What stands between words after lower-casing A-Z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 13
#: Windows that are broadcast at most, some 200 MB; more go through a shuffled join.
MOST_BROADCAST = 1_000_000


def words_of(text: Column) -> Column:
    # splitting at single spaces is several times faster than extracting matches
    parts = F.split(F.regexp_replace(F.translate(text, UPPER, LOWER), BETWEEN, " "), " ")
    return F.coalesce(F.filter(parts, lambda x: x != ""), F.array().cast("array<string>"))


def _at(words: str, start: Column, length: int) -> list[Column]:
    return [F.get(words, start + k) for k in range(length)]


def _hash(n: Column | int, hashes: Column, start: Column, most: int) -> Column:
    """A hash of n word hashes from start; `most` is the largest n."""
    if isinstance(n, int):
        return F.xxhash64(*[F.get(hashes, start + k) for k in range(n)])
    at = [F.when(F.lit(k) < n, F.get(hashes, start + k)) for k in range(most)]
    return F.xxhash64(*at)  # nulls leave the hash as it is


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per item and distinct window: __item, __n, __hash, __words."""
    items = (benchmark.select(F.col(item).alias("__item"), words_of(F.col(text)).alias("w"))
             .filter(F.size("w") > 0).withColumn("__n", F.least(F.size("w"), F.lit(window)))
             .select("__item", "w", "__n", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("__n"))).alias("i"))
             .select("__item", "__n", F.slice("w", F.col("i") + 1, F.col("__n")).alias("__words")))
    each = [F.xxhash64(x) for x in _at("__words", F.lit(0), window)]
    return items.withColumn("__hash", _hash(F.col("__n"), F.array(*each), F.lit(0), window)).distinct()


def find_hits(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id",
              item_text: str = "text", window: int = WINDOW, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """One row per distinct id and text: __id, __text (its hash), n_words, n_hit, and hits, the merged ranges of hit words, items, and rows.

    hits holds structs of start and end (exclusive), counted in words; items holds the ids of the
    items with windows that occur, as strings in order; rows is the number of documents with that id and text.
    """
    from_items = benchmark_windows(benchmark, item, item_text, window)
    kinds = from_items.select("__n", "__hash", "__words").distinct()
    # the lengths are 1 to `window`: a list of bounded size
    lengths = sorted(r[0] for r in kinds.select("__n").distinct().collect()) or [window]
    fits = kinds.count() <= most_broadcast
    small = F.broadcast if fits else (lambda df: df)

    texts = docs.select(F.col(id).alias("__id"), F.xxhash64(F.col(text)).alias("__text"), words_of(F.col(text)).alias("w"))
    texts = texts.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x)))
    every = texts.select("__id", "__text", "w", "wh", F.size("w").alias("n_words"),
                         F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - min(lengths), F.lit(0)))).alias("i"))
    tries = F.array(*[F.struct(F.lit(n).alias("n"),
                               _hash(n, F.col("wh"), F.col("i"), n).alias("h"))
                      for n in lengths])
    every = (every.select("__id", "__text", "w", "n_words", "i", F.inline(tries).alias("n", "h"))
             .withColumn("whole", F.col("i") + F.col("n") <= F.col("n_words")))
    if not fits:  # the words of a row travel through the shuffle, so only those of the window
        every = every.withColumn("w", F.slice("w", F.col("i") + 1, F.col("n"))).withColumn("o", F.lit(0))
    else:
        every = every.withColumn("o", F.col("i"))
    longest = max(lengths)
    same = F.lit(True)
    for k in range(longest):
        same &= (F.lit(k) >= F.col("__n")) | (F.get("w", F.col("o") + k) == F.get("__words", F.lit(k)))
    looked = every.join(small(kinds), (F.col("h") == F.col("__hash")) & (F.col("n") == F.col("__n")) & F.col("whole") & same,
                        "left")
    first = (F.col("i") == 0) & (F.col("n") == min(lengths))
    kept = (looked.filter(first | F.col("__hash").isNotNull())
            .select("__id", "__text", "n_words", "i", "__hash", "__n", first.alias("first")))

    # the end of the longest hit before: what lies beyond it is newly covered
    end = F.when(F.col("__hash").isNotNull(), F.col("i") + F.col("__n"))
    before = F.max(end).over(W.partitionBy("__id", "__text").orderBy("i", "__n")
                             .rowsBetween(W.unboundedPreceding, -1))
    from_ = F.greatest(F.col("i"), F.coalesce(before, F.lit(0)))
    new = F.when(end > from_, F.struct(from_.alias("start"), end.alias("end")))
    by_doc = (kept.withColumn("new", new)
              .groupBy("__id", "__text")
              .agg(F.max("n_words").cast("long").alias("n_words"), F.count_if("first").alias("rows"),
                   F.array_sort(F.collect_list("new")).alias("hits"),
                   F.collect_set(F.when(F.col("__hash").isNotNull(), F.struct("__hash", "__n"))).alias("found")))
    own = from_items.select("__item", F.col("__hash"), F.col("__n"))
    own = small(own) if own.count() <= most_broadcast else own
    named = (by_doc.select("__id", "__text", "n_words", "rows", "hits", F.inline_outer("found"))
             .join(own, ["__hash", "__n"], "left")
             .groupBy("__id", "__text")
             .agg(F.first("n_words").alias("n_words"), F.first("rows").alias("rows"), F.first("hits").alias("hits"),
                  F.array_sort(F.collect_set(F.col("__item").cast("string"))).alias("items")))
    covered = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return named.select("__id", "__text", "n_words", covered.alias("n_hit"), "hits", "items", "rows")


def contaminated(n_hit: Column, n_words: Column, one_in: int = 20) -> Column:
    return (n_hit > 0) & (n_hit * one_in >= n_words)


def _with_hits(docs: DataFrame, hits: DataFrame, id: str, text: str) -> DataFrame:
    return docs.join(hits, F.col(id).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text)) == F.col("__text")), "left")


def remove_documents(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents of which less than one word in 20 is in a window of the benchmark, unchanged."""
    hits = find_hits(docs, benchmark, id, text, **options).filter(contaminated(F.col("n_hit"), F.col("n_words")))
    return docs.join(hits.select("__id", "__text"),
                     F.col(id).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text)) == F.col("__text")), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """All documents, without the hit words and what follows each up to the next word."""
    hits = find_hits(docs, benchmark, id, text, **options).filter(F.size("hits") > 0)
    lead = F.regexp_extract(F.col(text), r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    parts = F.regexp_extract_all(F.col(text), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"), F.lit(0))
    left = F.filter(parts, lambda _, i: ~F.exists("__hits", lambda x: (x["start"] <= i) & (i < x["end"])))
    joined = _with_hits(docs, hits.select("__id", "__text", F.col("hits").alias("__hits")), id, text)
    new = F.when(F.col("__hits").isNotNull(), F.concat(lead, F.array_join(left, ""))).otherwise(F.col(text))
    return joined.select(*[new.alias(c) if c == text else docs[c] for c in docs.columns])


def op2_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    # a row for each document: those that repeat an id and its text have been worked on as one
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    return found.select(F.col("__id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


SQL = r"""
with d as (select doc_id, coalesce(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from documents),
b as (select item_id, coalesce(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from benchmark),
bw as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as g
       from (select item_id, w, least(len(w), 13) as n, unnest(range(1, len(w) - least(len(w), 13) + 2)) as i
             from b where len(w) > 0)),
dw as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as g
       from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
             from d, (select distinct n from bw) where len(w) >= n)),
hit as (select dw.doc_id, dw.i, dw.n, bw.item_id from dw join bw using (n, g)),
covered as (select doc_id, count(distinct p) as n_hit
            from (select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, i, n from hit)) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as ids
          from (select distinct doc_id, cast(item_id as varchar) as s from hit) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join covered using (doc_id) left join items using (doc_id)
"""

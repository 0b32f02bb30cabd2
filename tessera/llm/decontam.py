"""Benchmark decontamination with a distributed positional inverted index.

Training texts become postings (term, document row, position); every test
window (``width`` consecutive item words) is looked up by its rarest term:
corpus counts of the test terms are gathered first, each window is keyed by
the term with the shortest posting list, and the offset-adjusted positions of
that list are intersected with the other terms' positions, rarest next, until
the whole phrase stands at the adjusted start (compared as bytes, so a hash
collision cannot make a match). Postings of terms that are no window's rarest
term are never built.

The window table is broadcast only after its size has been measured; beyond
``broadcast_bytes`` the postings carry their word context and are shuffled by
term instead, with the same result.

Defined results: a null or empty text has no words and no hits; an item
without words has no window; an item with fewer than ``width`` words is one
window; equal windows of several items count for each item; an item with a
null id marks words but appears in no item list; repeated document rows are
scored each for itself (rows are told apart by their position in the input,
so the input must be re-readable in the same order, such as files or a
checkpoint). Extra columns may have any name that does not start with ``_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import materialise, row_schema
from .text import SENTINEL_LONG, TOKEN_COLUMNS, hash_words, tokens_batch

#: window tables up to this many bytes are broadcast to the postings scan
BROADCAST_BYTES = 64 << 20

_item_schema = "item string, m int, phrase binary, terms array<long>"


def _item_windows(width: int):
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            out = {"item": [], "m": [], "phrase": [], "terms": []}
            for r in rows:
                words = bytes(r["_norm"]).decode("utf-8", "surrogateescape").split(" ")[:-1]
                hashes = r["_tokens"][:-1]
                m = min(width, len(words))
                for i in range(len(words) - m + 1 if m else 0):
                    out["item"].append(r["_item"])
                    out["m"].append(m)
                    out["phrase"].append(" ".join(words[i:i + m]).encode("utf-8", "surrogateescape") + b" ")
                    out["terms"].append(hashes[i:i + m])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["item"], pa.string()), pa.array(out["m"], pa.int32()),
                 pa.array(out["phrase"], pa.binary()), pa.array(out["terms"], pa.list_(pa.int64()))],
                names=["item", "m", "phrase", "terms"])
    return run


def tokenised(df: DataFrame, text_col: str, keep: list[str], k: int = 1) -> DataFrame:
    """The kept columns and the words of each text (see ``text.tokens_batch``)."""
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("_text"))
    return src.mapInArrow(tokens_batch("alnum", "_text", keep, k), row_schema(src, keep, TOKEN_COLUMNS))


def windows(items: DataFrame, width: int, item_id: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct test windows: ``phrase``, its words' hashes ``terms``, ``m`` words, the ``items`` holding it."""
    src = items.select(F.col(item_id).cast("string").alias("_item"), F.col(text_col).alias("_text"))
    toks = tokenised(src, "_text", ["_item"])
    rows = toks.mapInArrow(_item_windows(width), _item_schema)
    return rows.groupBy("phrase").agg(F.first("m").alias("m"), F.first("terms").alias("terms"),
                                      F.collect_set("item").alias("items"))


def term_counts(tokens: DataFrame, terms: DataFrame, hint) -> DataFrame:
    """Length of the posting list of each given term over the whole corpus."""
    occ = tokens.select(F.explode("_tokens").alias("term"))
    return occ.join(hint(terms), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def _by_rarest(wins: DataFrame, counts: DataFrame) -> DataFrame:
    """Key every window by its rarest term: ``term``, its offset ``off``, the window."""
    t = wins.select("phrase", F.posexplode("terms").alias("off", "term"))
    t = t.join(counts, "term", "left").select(
        "phrase", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "off").alias("k"))
    best = t.groupBy("phrase").agg(F.min("k").alias("k"))
    # a term that no document holds: the window cannot occur
    best = best.where(F.col("k.n") > 0).select("phrase", F.col("k.term").alias("term"), F.col("k.off").alias("off"))
    return wins.join(best, "phrase")


def _bytes_at(start: Column, end: Column) -> Column:
    return F.substring(F.col("_norm"), start + 1, end - start)


def phrase_matches(docs: DataFrame, items: DataFrame, *, text_col: str = "text", keys: list[str],
                   width: int = 10, item_id: str = "item_id", item_text: str = "text",
                   broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Exact phrase matches: ``keys``, ``n`` words, ``start``, ``m``, ``items``.

    Every document also yields one row with a null ``start``, so that
    documents without a match keep their word count.
    """
    tokens = tokenised(docs, text_col, keys)
    wins = materialise(windows(items, width, item_id, item_text))
    size = wins.agg(F.coalesce(F.sum(F.length("phrase") + 8 * F.size("terms") + F.size("items") * 16 + 64), F.lit(0))).first()[0]
    small = size <= broadcast_bytes
    hint = F.broadcast if small else (lambda d: d)
    terms = wins.select(F.explode("terms").alias("term")).distinct()
    keyed = materialise(_by_rarest(wins, term_counts(tokens, terms, hint)))
    sentinel = docs.sparkSession.range(1).select(
        F.lit(None).cast("binary").alias("phrase"), F.lit(0).alias("m"), F.lit(None).cast("array<long>").alias("terms"),
        F.lit(None).cast("array<string>").alias("items"), F.lit(SENTINEL_LONG).alias("term"), F.lit(0).alias("off"))
    keyed = keyed.select("phrase", "m", "terms", "items", "term", "off").unionByName(sentinel)
    end_mark = F.col("pos") == F.col("_n")
    if small:
        post = tokens.select(*keys, "_n", "_norm", "_offs", F.posexplode("_tokens").alias("pos", "term"))
        hit = post.join(F.broadcast(keyed), "term")
        start = F.col("pos") - F.col("off")
        inside = (start >= 0) & (start + F.col("m") <= F.col("_n"))
        text = F.when(inside, _bytes_at(F.get("_offs", start), F.get("_offs", start + F.col("m"))))
        hit = hit.where(F.when(F.col("phrase").isNull(), end_mark).otherwise(text == F.col("phrase")))
    else:
        reach = width - 1
        lo = F.greatest(F.col("pos") - reach, F.lit(0))
        hi = F.least(F.col("pos") + reach + 1, F.col("_n"))
        post = tokens.select(*keys, "_n", "_norm", "_offs", F.posexplode("_tokens").alias("pos", "term")).select(
            *keys, "_n", "pos", "term", lo.alias("lo"), F.slice("_offs", lo + 1, hi - lo + 1).alias("ctx_offs"),
            _bytes_at(F.get("_offs", lo), F.get("_offs", hi)).alias("ctx"))
        hit = post.join(keyed, "term")
        start = F.col("pos") - F.col("off")
        inside = (start >= 0) & (start + F.col("m") <= F.col("_n"))
        a = F.get("ctx_offs", start - F.col("lo")) - F.get("ctx_offs", F.lit(0))
        b = F.get("ctx_offs", start - F.col("lo") + F.col("m")) - F.get("ctx_offs", F.lit(0))
        text = F.when(inside, F.substring(F.col("ctx"), a + 1, b - a))
        hit = hit.where(F.when(F.col("phrase").isNull(), end_mark).otherwise(text == F.col("phrase")))
    return hit.select(*keys, F.col("_n").alias("n"), F.when(F.col("phrase").isNotNull(), start).alias("start"), "m", "items")


def proximity_matches(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text",
                      item_id: str = "item_id", item_text: str = "text", slop: int = 10) -> DataFrame:
    """Documents in which the two rarest terms of an item stand at most ``slop`` words apart.

    Looser than a phrase: reworded copies keep their rare terms close together.
    Returns one row per (document, item): ``distance`` is the smallest one.
    Items need two different terms that occur in the corpus; the rarest two by
    corpus count, ties to the smaller term fingerprint.
    """
    tokens = tokenised(docs, text_col, [doc_id])
    src = items.select(F.col(item_id).cast("string").alias("_item"), F.col(item_text).alias("_text"))
    it = materialise(tokenised(src, "_text", ["_item"]).select("_item", F.explode("_tokens").alias("term")).distinct()
                     .where(F.col("term") != SENTINEL_LONG))
    counts = tokens.select(F.explode("_tokens").alias("term")).join(it.select("term").distinct(), "term") \
        .groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    two = it.join(counts, "term").groupBy("_item").agg(
        F.slice(F.array_sort(F.collect_set(F.struct("n", "term"))), 1, 2).alias("t")).where(F.size("t") == 2)
    two = materialise(two.select("_item", F.col("t")[0]["term"].alias("t1"), F.col("t")[1]["term"].alias("t2")))
    wanted = two.select(F.col("t1").alias("term")).union(two.select("t2")).distinct()
    post = tokens.select(F.col(f"`{doc_id}`"), F.posexplode("_tokens").alias("pos", "term")).join(wanted, "term")
    post = materialise(post)
    a = post.join(two, post["term"] == two["t1"]).select(doc_id, "_item", "t2", F.col("pos").alias("p1"),
                                                         F.floor(F.col("pos") / (slop + 1)).alias("cell"))
    # positions at most ``slop`` apart fall into the same or a neighbouring cell
    a = a.withColumn("cell", F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)))
    b = post.select(doc_id, F.col("term").alias("t2"), F.col("pos").alias("p2"), F.floor(F.col("pos") / (slop + 1)).alias("cell"))
    near = a.join(b, [doc_id, "t2", "cell"]).where(F.abs(F.col("p1") - F.col("p2")) <= slop)
    return near.groupBy(doc_id, "_item").agg(F.min(F.abs(F.col("p1") - F.col("p2"))).alias("distance")) \
        .withColumnRenamed("_item", "item_id")


def decontaminate(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text",
                  width: int = 10, row: str | None = None, **names) -> DataFrame:
    """One row per document row: ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted), ``contaminated``.

    ``row`` names a column of unique longs, which is returned too; without it rows are numbered here.
    """
    base = docs.select(F.col(f"`{doc_id}`").alias("_doc"), F.col(f"`{text_col}`").alias("_body"),
                       (F.col(f"`{row}`") if row else F.monotonically_increasing_id()).alias("_row"))
    m = phrase_matches(base, items, text_col="_body", keys=["_row", "_doc"], width=width, **names)
    span = F.when(F.col("start").isNotNull(), F.struct("start", (F.col("start") + F.col("m")).alias("end")))
    g = m.groupBy("_row").agg(F.first("_doc").alias("_doc"), F.first("n").alias("n_words"),
                              F.array_sort(F.collect_set(span)).alias("spans"),
                              F.collect_set("items").alias("lists"))
    step = F.aggregate(
        "spans", F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end")),
        lambda s, x: F.struct((s["hit"] + F.greatest(x["end"] - F.greatest(x["start"], s["end"]), F.lit(0))).alias("hit"),
                              F.greatest(s["end"], x["end"]).alias("end")))
    items_col = F.array_sort(F.array_distinct(F.flatten("lists")))
    return g.select(*([F.col("_row").alias(row)] if row else []), F.col("_doc").alias(doc_id), F.col("n_words").cast("long").alias("n_words"),
                    step["hit"].cast("long").alias("n_hit"), items_col.alias("items"),
                    F.size(items_col).cast("long").alias("n_items"),
                    (F.size("spans") > 0).alias("contaminated"))


__all__ = ["decontaminate", "phrase_matches", "proximity_matches", "windows", "hash_words"]

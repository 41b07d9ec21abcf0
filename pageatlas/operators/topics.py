"""Topics over focus vectors: centroids, weights, snippets, labels, merging, and the export."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageatlas.functions.page import excerpt, tokens
from pageatlas.functions.vector import cosine, dot, doubles, norm, normalized
from pageatlas.session import durable


def vector_sums(rows: DataFrame, key: str) -> DataFrame:
    """(key, v, n): sums of ``vector`` by key, by position, so that partial sums meet map-side."""
    each = rows.select(key, F.posexplode(doubles(F.col("vector"))).alias("pos", "x"))
    by_pos = each.groupBy(key, "pos").agg(F.sum("x").alias("s"), F.count("*").alias("n"))
    return by_pos.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "s"))).alias("p"), F.max("n").alias("n")).select(key, F.col("p.s").alias("v"), "n")


def page_vectors(focuses: DataFrame) -> DataFrame:
    """(version_id, v): normalised sum of a page's focus vectors."""
    return vector_sums(focuses, "version_id").select("version_id", normalized(F.col("v")).alias("v"))


def centroids(focuses: DataFrame) -> DataFrame:
    """(topic, c, n): mean vector of each topic; noise (topic < 0) has none."""
    return vector_sums(focuses.where("topic >= 0"), "topic").select("topic", F.transform("v", lambda x: x / F.col("n")).alias("c"), "n")


def centroid_pairs(cents: DataFrame) -> DataFrame:
    """(a, b, cos), a < b: the similarities of all topics; there are few of them."""
    left, right = cents.select(F.col("topic").alias("a"), F.col("c").alias("ca")), cents.select(F.col("topic").alias("b"), F.col("c").alias("cb"))
    return left.join(right, F.col("a") < F.col("b")).select("a", "b", cosine(F.col("ca"), F.col("cb")).alias("cos"))


def merge_similar(cents: DataFrame, threshold: float = 0.85) -> dict[int, int]:
    """Topic -> topic it is merged into: the most similar pair again and again, the larger number into
    the smaller, until none reaches the threshold; of equal pairs the one of the largest numbers. Runs on
    sums and counts, a row per topic; each topic keeps its most similar later one, never all pairs."""
    import numpy as np

    rows = cents.orderBy("topic").toArrow()  # a row per topic
    ids = rows["topic"].to_pylist()
    if not ids:
        return {}
    total = np.array(rows["c"].to_pylist(), dtype=float) * np.array(rows["n"].to_pylist(), dtype=float)[:, None]
    unit = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-12)
    k = len(ids)
    best, near, alive = np.full(k, -2.0), np.full(k, -1), np.ones(k, dtype=bool)

    def look(which: np.ndarray) -> None:
        """The most similar living later topic of each, the latest of equals."""
        for lo in range(0, len(which), 256):
            w = which[lo : lo + 256]
            sims = unit[w] @ unit.T
            sims[(np.arange(k)[None, :] <= w[:, None]) | ~alive[None, :]] = -2.0
            near[w] = k - 1 - sims[:, ::-1].argmax(axis=1)
            best[w] = sims[np.arange(len(w)), near[w]]

    look(np.arange(k))
    into = np.arange(k)
    while True:
        top = best.max()
        if top < threshold or top <= -2.0:
            break
        a = int(k - 1 - best[::-1].argmax())
        b = int(near[a])
        total[a] += total[b]
        unit[a] = total[a] / max(np.linalg.norm(total[a]), 1e-12)
        alive[b], best[b] = False, -2.0
        into[into == b] = a
        stale = alive & (best > -2.0) & ((near == a) | (near == b))
        stale[a] = True
        look(np.flatnonzero(stale))
        sims = unit[:a] @ unit[a]  # a may now be nearer to earlier ones than what they had
        closer = alive[:a] & ((sims > best[:a]) | ((sims == best[:a]) & (near[:a] < a)))
        best[:a][closer], near[:a][closer] = sims[closer], a
    return {t: ids[j] for t, j in zip(ids, into.tolist())}


def prune_small(focuses: DataFrame, min_pages: int = 3) -> DataFrame:
    """Topics on fewer than ``min_pages`` pages become noise."""
    pages = focuses.where("topic >= 0").groupBy("topic").agg(F.count_distinct("version_id").alias("pages"))
    return focuses.join(pages, "topic", "left").withColumn("topic", F.when(F.col("pages") >= min_pages, F.col("topic")).otherwise(F.lit(-1))).drop("pages")


def page_topic_weights(focuses: DataFrame) -> DataFrame:
    """(version_id, topic, weight): a page's share of focuses on a topic, of all it has, noise included."""
    n = focuses.groupBy("version_id", "topic").agg(F.count("*").alias("k"))
    whole = F.sum("k").over(Window.partitionBy("version_id"))
    return n.withColumn("weight", F.col("k") / whole).where("topic >= 0").select("version_id", "topic", "weight")


def snippets(focuses: DataFrame, cents: DataFrame) -> DataFrame:
    """(version_id, topic, snippet): the summary nearest to the centroid; ties by focus_id."""
    sim = dot(doubles(F.col("vector")), F.col("c")) / F.greatest(norm(F.col("c")), F.lit(1e-9))
    near = focuses.where("topic >= 0").join(cents.select("topic", "c"), "topic").withColumn("far", -sim)
    return near.groupBy("version_id", "topic").agg(F.min_by("summary", F.struct("far", "focus_id")).alias("snippet"))


def primary_topics(weights: DataFrame, pages: DataFrame) -> DataFrame:
    """(version_id, cluster_id): the topic of the greatest weight, the lower on ties; -1 for none."""
    top = weights.groupBy("version_id").agg(F.max(F.struct("weight", (-F.col("topic")).alias("neg")))["neg"].alias("neg"))
    return pages.select("version_id").distinct().join(top, "version_id", "left").select("version_id", F.coalesce(-F.col("neg"), F.lit(-1)).alias("cluster_id"))


def topic_samples(focuses: DataFrame, cents: DataFrame, size: int = 10) -> DataFrame:
    """(topic, rank, focus_id): the ``size`` focuses with the greatest dot product with the centroid."""
    scored = focuses.where("topic >= 0").join(cents.select("topic", "c"), "topic").withColumn("score", dot(doubles(F.col("vector")), F.col("c")))
    w = Window.partitionBy("topic").orderBy(F.desc("score"), "focus_id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= size).select("topic", "rank", "focus_id")


def passage_terms(passages: DataFrame, key: str) -> DataFrame:
    """(key, term, tf): words and pairs of neighbouring words of the passages of a key, in order of ``pos``;
    pairs reach across passages. Every passage keeps its words; only its neighbour's first word crosses."""
    w = passages.select(key, "pos", tokens(F.col("text")).alias("t")).where(F.size("t") > 0)
    nxt = F.lead(F.get("t", F.lit(0))).over(Window.partitionBy(key).orderBy("pos"))
    w = w.withColumn("u", F.when(nxt.isNotNull(), F.concat("t", F.array(nxt))).otherwise(F.col("t")))
    pairs = F.transform(F.sequence(F.lit(1), F.size("u") - 1), lambda i: F.concat_ws(" ", F.element_at("u", i), F.element_at("u", i + 1)))
    terms = F.concat("t", F.when(F.size("u") > 1, pairs).otherwise(F.array().cast("array<string>")))
    return w.select(key, F.explode(terms).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


def label_vocabulary(passages: DataFrame, max_share: float = 0.4) -> DataFrame:
    """(term, page_df) of terms on at least two pages and on no more than a share of them."""
    df = passage_terms(passages, "page").groupBy("term").agg(F.count("*").alias("page_df"))
    n = passages.agg(F.count_distinct("page").alias("n"))
    return df.crossJoin(F.broadcast(n)).where((F.col("page_df") >= 2) & (F.col("page_df") <= F.greatest(F.lit(3.0), max_share * F.col("n")))).select("term", "page_df")


def label_scores(passages: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(topic, term, score): class-based tf-idf; the mean of tf counts all cells, empty ones as zero."""
    tf = passage_terms(passages.where("topic >= 0"), "topic").join(vocabulary.select("term"), "term")
    share = tf.withColumn("tf", F.col("tf") / F.greatest(F.sum("tf").over(Window.partitionBy("topic")), F.lit(1)))
    by_term = share.groupBy("term").agg(F.sum("tf").alias("total"))
    whole = share.agg(F.sum("tf").alias("sum_tf"))
    terms = vocabulary.agg(F.count("*").alias("v"))
    # T * mean = T * sum / (T * V)
    return share.join(by_term, "term").crossJoin(F.broadcast(whole)).crossJoin(F.broadcast(terms)).select(
        "topic", "term", (F.col("tf") * F.log1p((F.col("sum_tf") / F.col("v")) / F.greatest("total", F.lit(1e-12)))).alias("score")
    )


def pick_labels(scores: DataFrame, topics: list[int], terms: int = 3, candidates: int = 200) -> dict[int, str]:
    """Topic -> label: its best terms, topics in order, no word twice in any label; ``theme n`` if none is left.

    The best ``candidates`` terms of each topic come to the driver; where a topic finds too few among them,
    more do, until it has its terms or there are no more. Of equal scores the later term comes first.
    """
    w = Window.partitionBy("topic").orderBy(F.desc("score"), F.desc("term"))
    ranked = durable(scores.where("score > 0").withColumn("rn", F.row_number().over(w)))
    while True:
        by_topic: dict[int, list[str]] = {}
        for r in ranked.where(F.col("rn") <= candidates).orderBy("topic", "rn").collect():
            by_topic.setdefault(r["topic"], []).append(r["term"])
        used: set[str] = set()
        out, short = {}, False
        for t in sorted(topics):
            picked: list[str] = []
            for term in by_topic.get(t, []):
                if len(picked) < terms and not used & set(term.split()):
                    picked.append(term)
                    used |= set(term.split())
            short = short or (len(picked) < terms and len(by_topic.get(t, [])) == candidates)
            out[t] = ", ".join(picked) or f"theme {t}"
        if not short:
            return out
        candidates *= 4


def first_quotes(extractions: DataFrame) -> DataFrame:
    """(version_id, quote): the first quote of the latest extraction that has any."""
    q = F.get_json_object("json", "$.quotes[0]")
    e = extractions.withColumn("q", q).where(F.length("q") > 0)
    return e.groupBy("version_id").agg(F.max_by("q", F.struct(F.coalesce("created_at", F.lit("")), "prompt_version", "q")).alias("quote"))


def topic_pages(weights: DataFrame) -> DataFrame:
    return weights.where("weight > 0").groupBy("topic").agg(F.count_distinct("version_id").alias("pages"))


def export_points(pages: DataFrame, weights: DataFrame, snips: DataFrame, quotes: DataFrame, people: DataFrame, excerpt_chars: int = 280) -> DataFrame:
    """One row per page with its owner, excerpt and topics as JSON, heaviest first."""
    now = people.where(F.coalesce("valid_to", F.lit("")) == "").groupBy("url").agg(F.max(F.struct(F.coalesce("valid_from", F.lit("")).alias("f"), "name", "city", "country")).alias("p"))
    t = weights.join(snips, ["version_id", "topic"], "left").withColumn("w", F.bround("weight", 3))
    topics = t.groupBy("version_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("w")).alias("neg"), "topic", "w", "snippet"))).alias("t"))
    listed = F.transform("t", lambda x: F.struct(x["topic"].alias("id"), x["w"].alias("weight"), x["snippet"].alias("snippet")))
    return (
        pages.join(topics, "version_id", "left").join(quotes, "version_id", "left").join(now, "url", "left")
        .select(
            F.col("version_id").alias("id"), "url", "p.name", "p.city", "p.country", F.col("last_seen").alias("captured_at"),
            F.coalesce("quote", excerpt(F.col("text_md"), excerpt_chars)).alias("excerpt"), F.coalesce(F.to_json(listed), F.lit("[]")).alias("topics"),
        )
    )


def usable_focus_vectors(vectors: DataFrame, model: str = "sentence-mini-64", dim: int = 64) -> DataFrame:
    """(focus_id, vector) of a model's focus vectors with ``dim`` finite elements, not all zero, each once."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where((F.col("model") == model) & (F.col("kind") == "focus") & (F.size(v) == dim) & finite & F.exists(v, lambda x: x != 0))
    return rows.select(F.col("id").alias("focus_id"), "vector").distinct()


def embedded_focuses(focuses: DataFrame, vectors: DataFrame) -> DataFrame:
    """Focuses, each row once, with their vector."""
    return focuses.distinct().join(usable_focus_vectors(vectors), "focus_id")

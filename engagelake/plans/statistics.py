"""Queries over sampling, distribution tests, embedding diagnostics and key frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..functions import columns as c
from ..operators import embeddings as e
from ..operators import media, quantiles, sampling

TARGET = 100


def _population(spark, sf_dir):
    d = b.table(spark, sf_dir, "documents")
    q33, q66 = quantiles.terciles(d, F.col("n_chars"))
    binned = d.withColumn("bin", c.three_bins(F.col("n_chars"), F.lit(q33), F.lit(q66)))
    return binned.select("doc_id", "lang", F.when(F.col("doc_id") % 4 == 0, "image").otherwise("text").alias("modality"), "bin", "n_chars",
        F.col("doc_id").alias("seq"), "source")


def _sample(spark, sf_dir):
    return sampling.stratified(_population(spark, sf_dir), ["lang", "modality", "bin"], sampling.hash_sample_rank(42, "doc_id", "source"), "seq",
        TARGET)


def stratified_sample(spark, sf_dir):
    return _sample(spark, sf_dir).select("doc_id", "lang", "modality", "bin")


def sampling_shares(spark, sf_dir):
    p, s = _population(spark, sf_dir), _sample(spark, sf_dir)
    a = p.groupBy("lang").agg(F.count("*").alias("n")).crossJoin(p.agg(F.count("*").alias("total")))
    d = s.groupBy("lang").agg(F.count("*").alias("m")).crossJoin(s.agg(F.count("*").alias("sampled")))
    return a.join(d, "lang", "left").select("lang", F.round(F.col("n") / F.col("total"), 6).alias("share"),
        F.round(F.coalesce(F.col("m") / F.col("sampled"), F.lit(0.0)), 6).alias("sample_share"))


def ks_statistic(spark, sf_dir):
    return sampling.ks_distance(_population(spark, sf_dir), _sample(spark, sf_dir), "n_chars").select(F.round("d", 9).alias("d"), "n", "m")


def ks_pvalue(spark, sf_dir):
    ks = sampling.ks_distance(_population(spark, sf_dir), _sample(spark, sf_dir), "n_chars")
    return ks.select(F.round(sampling.ks_pvalue(F.col("d"), F.col("n"), F.col("m")), 6).alias("p"))


def chi2_statistic(spark, sf_dir):
    return sampling.chi_square(_population(spark, sf_dir), _sample(spark, sf_dir), "lang").select(F.round("statistic", 6).alias("statistic"), "df")


def chi2_pvalue(spark, sf_dir):
    x = sampling.chi_square(_population(spark, sf_dir), _sample(spark, sf_dir), "lang")
    return x.select(F.round(sampling.chi_square_pvalue(F.col("statistic"), F.col("df")), 6).alias("p"))


def synthetic_posts(spark, sf_dir):
    """As many made posts as there are orders, by their keys."""
    ids = b.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return sampling.synthetic_posts(ids).select("post_id", "group_id", "subject", "modality", "text_length", "duration", "likes")


def vector_norm_report(spark, sf_dir):
    return e.norm_report(b.table(spark, sf_dir, "embeddings"))


def anisotropy_all_pairs(spark, sf_dir):
    return e.anisotropy(b.table(spark, sf_dir, "embeddings"))


def label_centre_cosines(spark, sf_dir):
    """Cosine of every vector with its label's mean direction."""
    d = b.table(spark, sf_dir, "embeddings").where("label is not null")
    long = d.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.sum(F.col("x").cast("double")).alias("s"))
    centre = long.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda p: p["s"]).alias("centre"))
    cosine = c.dot(F.col("embedding"), F.col("centre")) / (c.norm(F.col("embedding")) * c.norm(F.col("centre")))
    return d.join(centre, "label").select("vec_id", F.round(cosine, 5).alias("cosine"))


def hopkins(spark, sf_dir):
    return e.hopkins(b.table(spark, sf_dir, "embeddings"))


def pca_spectrum(spark, sf_dir):
    return e.spectrum(b.table(spark, sf_dir, "embeddings"))


def mock_embeddings(spark, sf_dir):
    return e.mock_embeddings(b.table(spark, sf_dir, "documents"), "doc_id", "text", "lang")


def mad_keyframes(spark, sf_dir):
    ev = b.table(spark, sf_dir, "events")
    return media.key_frames(ev, ["user_id"], [F.asc("ts"), F.asc("event_id")], F.col("value"), 40.0, 5, 2).select("user_id", "event_id", "frame")


def grid_search(spark, sf_dir):
    """The best setting of a small grid: first strict maximum by score, then grid order."""
    ev = b.table(spark, sf_dir, "events")
    w = ev.groupBy("user_id").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    grid = spark.createDataFrame([(i, float(t)) for i, t in enumerate((5, 10, 20, 40, 80))], "g int, threshold double")
    scored = w.crossJoin(F.broadcast(grid)).withColumn("similarity", 1 - F.col("threshold") / 200).withColumn("compression",
        F.col("n") * F.col("threshold") / (F.col("high") - F.col("low") + 1))
    best = scored.groupBy("g").agg(F.round(F.avg(media.grid_score(F.col("similarity"), F.col("compression"))), 6).alias("score"))
    return best.orderBy(F.desc("score"), "g").limit(1)


_POP = """p0 AS (SELECT *, CASE WHEN doc_id % 4 = 0 THEN 'image' ELSE 'text' END AS modality FROM documents), q AS (SELECT quantile_cont(n_chars,
    0.33) AS a, quantile_cont(n_chars, 0.66) AS b FROM documents),
 p AS (SELECT doc_id, lang, modality, CASE WHEN n_chars <= a THEN 'low' WHEN n_chars <= b THEN 'mid' ELSE 'high' END AS bin, n_chars, source, doc_id
    AS seq FROM p0, q),
 h AS (SELECT *, list_reduce(list_prepend(0::BIGINT, list_transform(range(8), lambda i: ('0x' || substr(sha256('42:' || doc_id || ':' || source),
    CAST(8*i+1 AS BIGINT), 8))::BIGINT)), lambda x, w: (x * 294967296 + w) % 1000000000) AS r FROM p),
 z AS (SELECT lang, modality, bin, count(*) AS n, min(seq) AS first, (SELECT count(*) FROM p) AS total FROM p GROUP BY 1, 2, 3), k AS (SELECT *,
    least(n, CAST(floor(100::DOUBLE * (n::DOUBLE / total::DOUBLE)) AS BIGINT)) AS k FROM z),
 t AS (SELECT *, row_number() OVER (ORDER BY n - k DESC, k, first) AS turn, 100 - sum(k) OVER () AS spare FROM k), u AS (SELECT lang, modality, bin, k
    + CASE WHEN turn <= spare AND k < n THEN 1 ELSE 0 END AS quota FROM t),
 s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, modality, bin ORDER BY r, seq) AS nth FROM h) JOIN u USING (lang, modality, bin)
    WHERE nth <= quota)"""
_KS = """x AS (SELECT n_chars AS v, count(*) AS cp FROM p GROUP BY 1), y AS (SELECT n_chars AS v, count(*) AS cs FROM s GROUP BY 1), g AS (SELECT v,
    sum(cp) OVER (ORDER BY v) / (SELECT count(*) FROM p)::DOUBLE AS fp, sum(coalesce(cs,0)) OVER (ORDER BY v) / (SELECT count(*) FROM s)::DOUBLE AS fs
    FROM x LEFT JOIN y USING (v)),
 d AS (SELECT max(abs(fp - fs)) AS d, (SELECT count(*) FROM p) AS n, (SELECT count(*) FROM s) AS m FROM g)"""
_CHI = """a AS (SELECT lang, count(*) AS p FROM p GROUP BY 1), b AS (SELECT lang, count(*) AS s FROM s GROUP BY 1), e AS (SELECT coalesce(s, 0) AS s,
    p * (SELECT count(*) FROM s) / (SELECT count(*) FROM p)::DOUBLE AS e FROM a LEFT JOIN b USING (lang))"""
_LAM = "((sqrt(n*m/(n+m)::DOUBLE) + 0.12 + 0.11/sqrt(n*m/(n+m)::DOUBLE)) * d)"
QUERIES = {
    "stratified_sample": (stratified_sample, f"WITH {_POP} SELECT doc_id, lang, modality, bin FROM s"),
    "sampling_shares": (sampling_shares, f"""WITH {_POP} SELECT lang, round(count(*) / (SELECT count(*) FROM p)::DOUBLE, 6) AS share, round((SELECT
        count(*) FROM s WHERE s.lang = p.lang) / (SELECT count(*) FROM s)::DOUBLE, 6) AS sample_share FROM p GROUP BY lang"""),
    "ks_statistic": (ks_statistic, f"WITH {_POP}, {_KS} SELECT round(d, 9) AS d, n, m FROM d"),
    "ks_pvalue": (ks_pvalue, f"""WITH {_POP}, {_KS} SELECT round(greatest(0, least(1, list_sum(list_transform(range(1, 101), lambda k: 2 * pow(-1, k -
        1) * exp(-2.0 * k * k * {_LAM} * {_LAM}))))), 6) AS p FROM d"""),
    "chi2_statistic": (chi2_statistic, f"""WITH {_POP}, {_CHI} SELECT round(sum((s - e) * (s - e) / e), 6) AS statistic, greatest(count(*) - 1, 1) AS
        df FROM e"""),
    # the error function by its series, whose terms are all of one sign
    "chi2_pvalue": (chi2_pvalue, f"""WITH {_POP}, {_CHI}, one AS (SELECT sum((s - e) * (s - e) / e) AS x2, greatest(count(*) - 1, 1)::DOUBLE AS df
        FROM e), score AS (SELECT x2, (pow(x2 / df, 1::DOUBLE / 3) - (1 - 2 / (9 * df))) / sqrt(2 / (9 * df)) / sqrt(2) AS x FROM one)
        SELECT round(CASE WHEN x2 <= 0 THEN 1 ELSE (1 - exp(-x * x) * list_sum(list_transform(range(100), lambda n: pow(x, 2 * n + 1) / gamma(n +
        1.5)))) / 2 END, 6) AS p FROM score"""),
    "synthetic_posts": (synthetic_posts, """SELECT i + 10000 AS post_id, i % 50 + 1 AS group_id, (['cafe','retail','beauty','sport'])[i % 4 + 1] AS
        subject, (['text_only','text_image','text_video','trimodal'])[i % 4 + 1] AS modality, (i * 37) % 800 + 20 AS text_length, CASE WHEN i % 4 >= 2
        THEN i % 120 + 5 ELSE 0 END AS duration, i % 100 AS likes FROM (SELECT o_orderkey AS i FROM orders)"""),
    "vector_norm_report": (vector_norm_report, """WITH v AS (SELECT embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE *
        x::DOUBLE))) AS n FROM embeddings) SELECT count(*) AS vectors, count(*) FILTER (WHERE len(list_filter(embedding, lambda x: isnan(x) OR
        isinf(x))) > 0) AS bad, count(*) FILTER (WHERE n < 1e-5) AS zero, bool_and(abs(n - 1) < 1e-3) AS unit_norms, round(avg(n), 6) AS mean_norm
        FROM v"""),
    "anisotropy_all_pairs": (anisotropy_all_pairs, """WITH l AS (SELECT generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM
        embeddings), p AS (SELECT i, sum(x) AS s, sum(x * x) AS q, count(*) AS n FROM l GROUP BY 1) SELECT round((sum(s * s) - sum(q)) / (max(n) *
        (max(n) - 1)), 6) AS anisotropy, max(n) AS vectors FROM p"""),
    "label_centre_cosines": (label_centre_cosines, """WITH l AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x
        FROM embeddings), c AS (SELECT label, i, sum(x) AS s FROM l GROUP BY 1, 2), v AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS
        i, unnest(embedding)::DOUBLE AS x FROM embeddings)
        SELECT vec_id, round(sum(x * s) / (sqrt(sum(x * x)) * sqrt(sum(s * s))), 5) AS cosine FROM v JOIN c USING (label, i) GROUP BY 1"""),
    "hopkins": (hopkins, None),
    "pca_spectrum": (pca_spectrum, None),
    "mock_embeddings": (mock_embeddings, None),
    "mad_keyframes": (mad_keyframes, """WITH s AS (SELECT user_id, event_id, row_number() OVER w AS frame, CASE WHEN row_number() OVER w = 1 THEN 1.0
        ELSE abs(value - lag(value) OVER w) END AS score FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY frame <> 1, score DESC, frame) AS nth FROM s) SELECT user_id, event_id,
        CAST(frame AS INT) AS frame FROM n WHERE frame = 1 OR (score > 40 AND nth <= 5) OR nth <= 2"""),
    "grid_search": (grid_search, """WITH w AS (SELECT user_id, count(*) AS n, min(value) AS low, max(value) AS high FROM events GROUP BY 1), g AS
        (SELECT i AS g, ([5.0,10,20,40,80])[i + 1]::DOUBLE AS t FROM range(5) r(i)),
        s AS (SELECT g, 1 - t / 200 AS sim, n * t / (high - low + 1) AS comp FROM w, g), x AS (SELECT g, sim * (1 + 0.2 * ln(1 + comp)) / CASE WHEN
        sim < 0.85 THEN 2 ELSE 1 END AS sc FROM s) SELECT CAST(g AS INT) AS g, round(avg(sc), 6) AS score FROM x GROUP BY 1 ORDER BY score DESC, g
        LIMIT 1"""),
}

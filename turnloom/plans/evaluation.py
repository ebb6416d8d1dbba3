"""Evaluation of a stub scorer over the slots, and vector operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnloom.functions import text as X
from turnloom.operators import evaluate as E
from turnloom.plans import slots as P
from turnloom.plans.common import sql_uniform
from turnloom.registry import Registry
from turnloom.session import table

registry = Registry()
KEY = ["record_id", "turn", "word_index"]


def _u(tag):
    return X.uniform(F.col("record_id"), F.col("turn"), F.col("word_index"), F.lit(tag))


def _su(tag):
    return sql_uniform("record_id", "turn", "word_index", f"'{tag}'")


#: Human distributions h1..h3 (some all zero, hence silent) and the logits of a deterministic stub scorer, in head order.
SQL_EVAL = f"""{P.SQL_W},
raw AS (SELECT record_id, turn, word_index, CASE WHEN word_index % 7 = 0 THEN 0 ELSE {_su('hb')} END AS a, CASE WHEN word_index % 7 = 0 THEN 0 ELSE {_su('hf')} * 0.5 END AS b, CASE WHEN word_index % 7 = 0 THEN 0 ELSE {_su('hs')} END AS c,
  4 * {_su('lb')} - 2 AS x, 4 * {_su('lf')} - 2 AS y, 4 * {_su('ls')} - 1 AS z FROM sa),
ev AS (SELECT record_id, turn, word_index, CASE WHEN a + b + c <= 0 THEN 0.0 ELSE a / (a + b + c) END AS h1, CASE WHEN a + b + c <= 0 THEN 0.0 ELSE b / (a + b + c) END AS h2, CASE WHEN a + b + c <= 0 THEN 1.0 ELSE c / (a + b + c) END AS h3,
  exp(x - greatest(x, y, z)) / (exp(x - greatest(x, y, z)) + exp(y - greatest(x, y, z)) + exp(z - greatest(x, y, z))) AS q1,
  exp(y - greatest(x, y, z)) / (exp(x - greatest(x, y, z)) + exp(y - greatest(x, y, z)) + exp(z - greatest(x, y, z))) AS q2,
  exp(z - greatest(x, y, z)) / (exp(x - greatest(x, y, z)) + exp(y - greatest(x, y, z)) + exp(z - greatest(x, y, z))) AS q3 FROM raw),
lab AS (SELECT *, CASE WHEN h1 >= h2 AND h1 >= h3 THEN 'backchannel' WHEN h2 >= h3 THEN 'interruption' ELSE 'none' END AS label, CASE WHEN q1 >= q2 AND q1 >= q3 THEN 'backchannel' WHEN q2 >= q3 THEN 'interruption' ELSE 'none' END AS pred,
  CASE WHEN h1 > 0 THEN h1 * ln(h1 / greatest(q1, 1e-12)) ELSE 0 END + CASE WHEN h2 > 0 THEN h2 * ln(h2 / greatest(q2, 1e-12)) ELSE 0 END + CASE WHEN h3 > 0 THEN h3 * ln(h3 / greatest(q3, 1e-12)) ELSE 0 END AS kl FROM ev)"""


def human():
    off = F.col("word_index") % 7 == 0
    return E.renormed(*[F.when(off, 0.0).otherwise(x) for x in (_u("hb"), _u("hf") * 0.5, _u("hs"))])


def predicted():
    return E.softmax(F.array(4 * _u("lb") - 2, 4 * _u("lf") - 2, 4 * _u("ls") - 1))


def humans(spark, sf_dir):
    return P.t1_slots(spark, sf_dir).select(*KEY, human().alias("human"))


def predictions(spark, sf_dir):
    return P.t1_slots(spark, sf_dir).select(*KEY, predicted().alias("pred"))


def evaluated(spark, sf_dir):
    """Each slot's human distribution and that of the scorer, which is asked in its row, with labels and divergence."""
    rows = P.t1_slots(spark, sf_dir).select(*KEY, human().alias("human"), predicted().alias("pred"))
    name = lambda x: F.element_at(F.array(*map(F.lit, E.HEAD)), E.argmax(F.col(x)) + 1)
    return rows.select(*KEY, name("human").alias("label"), name("pred").alias("predicted"), E.kl(F.col("human"), F.col("pred")).alias("kl"), "human", "pred")


@registry.query("j12_joined_predictions", f"WITH {SQL_EVAL}, j AS (SELECT h.record_id, h.turn, h.word_index, h.h1, h.h2, h.h3, p.q1 IS NULL AS missing, coalesce(p.q1, 1 / 3.0) AS q1, coalesce(p.q2, 1 / 3.0) AS q2, coalesce(p.q3, 1 / 3.0) AS q3 FROM ev h LEFT JOIN (SELECT * FROM ev WHERE word_index % 5 <> 0) p ON p.record_id = h.record_id AND p.turn = h.turn AND p.word_index = h.word_index) SELECT record_id, turn, word_index, missing, round(CASE WHEN h1 > 0 THEN h1 * ln(h1 / greatest(q1, 1e-12)) ELSE 0 END + CASE WHEN h2 > 0 THEN h2 * ln(h2 / greatest(q2, 1e-12)) ELSE 0 END + CASE WHEN h3 > 0 THEN h3 * ln(h3 / greatest(q3, 1e-12)) ELSE 0 END, 9) AS kl FROM j")
def j12_joined_predictions(spark, sf_dir):
    """Slots joined to predictions that came from elsewhere and lack some of them; a slot without one has the uniform distribution."""
    given = predictions(spark, sf_dir).where("word_index % 5 != 0")
    rows = humans(spark, sf_dir).join(given, KEY, "left")
    pred = F.coalesce("pred", F.array(*[F.lit(1 / 3)] * 3))
    return rows.select(*KEY, F.col("pred").isNull().alias("missing"), F.round(E.kl(F.col("human"), pred), 9).alias("kl"))


@registry.query("t15_evaluated_slots", f"WITH {SQL_EVAL} SELECT record_id, turn, word_index, label, pred AS predicted, round(kl, 9) AS kl FROM lab")
def t15_evaluated_slots(spark, sf_dir):
    """Every slot with its label, prediction and divergence."""
    return evaluated(spark, sf_dir).select(*KEY, "label", "predicted", F.round("kl", 9).alias("kl"))


@registry.query("t3_normalised_scores", f"WITH {SQL_EVAL} SELECT record_id, turn, word_index, round(q1, 9) AS p_backchannel, round(q2, 9) AS p_floor_taking, round(q3, 9) AS p_silence FROM ev")
def t3_normalised_scores(spark, sf_dir):
    """The scorer's distribution under canonical names."""
    p = predictions(spark, sf_dir)
    return p.select(*KEY, *[F.round(F.col("pred")[i], 9).alias(x) for i, x in enumerate(("p_backchannel", "p_floor_taking", "p_silence"))])


@registry.query("a3_mean_kl", f"WITH {SQL_EVAL} SELECT round(avg(kl), 6) AS mean_kl, count(*) AS n, sum(CASE WHEN h3 = 1.0 THEN 1 ELSE 0 END) AS n_fallback FROM lab")
def a3_mean_kl(spark, sf_dir):
    """The mean divergence, the slots, and those without a human vote."""
    e = evaluated(spark, sf_dir)
    return e.agg(F.round(F.avg("kl"), 6).alias("mean_kl"), F.count("*").alias("n"), F.count_if(F.col("human")[2] == 1.0).alias("n_fallback"))


_GRID = "grid AS (SELECT a.l AS label, b.l AS pred FROM (VALUES ('backchannel'), ('interruption'), ('none')) a(l), (VALUES ('backchannel'), ('interruption'), ('none')) b(l))"


@registry.query("a4_confusion", f"WITH {SQL_EVAL}, {_GRID}, n AS (SELECT label, pred, count(*) AS n FROM lab GROUP BY ALL), f AS (SELECT label, pred, coalesce(n, 0) AS n FROM grid LEFT JOIN n USING (label, pred)) SELECT label, pred, n, CASE WHEN sum(n) OVER (PARTITION BY label) = 0 THEN 0 ELSE n / sum(n) OVER (PARTITION BY label) END AS share FROM f")
def a4_confusion(spark, sf_dir):
    """Labels against predictions, counted and as shares of the label."""
    return E.confusion(evaluated(spark, sf_dir), "label", "predicted")


def _sql_scores():
    cols, f1s = ["round(hit / n, 9) AS accuracy"], []
    sums = ["count(*) AS n", "sum(CASE WHEN label = pred THEN 1 ELSE 0 END) AS hit"]
    for i, x in enumerate(E.HEAD):
        sums += [f"sum(CASE WHEN label = pred AND label = '{x}' THEN 1 ELSE 0 END) AS tp{i}", f"sum(CASE WHEN pred = '{x}' THEN 1 ELSE 0 END) AS pp{i}", f"sum(CASE WHEN label = '{x}' THEN 1 ELSE 0 END) AS lp{i}"]
        p, r = f"coalesce(tp{i} / nullif(pp{i}, 0), 0)", f"coalesce(tp{i} / nullif(lp{i}, 0), 0)"
        f1 = f"coalesce(2 * {p} * {r} / nullif({p} + {r}, 0), 0)"
        f1s.append(f1)
        cols += [f"round({p}, 9) AS precision_{x}", f"round({r}, 9) AS recall_{x}", f"round({f1}, 9) AS f1_{x}"]
    return f"WITH {SQL_EVAL}, s AS (SELECT {', '.join(sums)} FROM lab) SELECT {', '.join(cols)}, round(({' + '.join(f1s)}) / 3, 9) AS macro_f1 FROM s"


@registry.query("a5_scores", _sql_scores())
def a5_scores(spark, sf_dir):
    """Accuracy, precision, recall and F1 of each class, and their mean."""
    return E.scores(evaluated(spark, sf_dir), "label", "predicted")


@registry.query("a7_renormed", f"WITH {SQL_EVAL} SELECT record_id, turn, word_index, round(h1, 9) AS p_backchannel, round(h2, 9) AS p_interruption, round(h3, 9) AS p_none FROM ev")
def a7_renormed(spark, sf_dir):
    """Human weights as distributions; none where there is no weight."""
    return humans(spark, sf_dir).select(*KEY, *[F.round(F.col("human")[i], 9).alias(x) for i, x in enumerate(("p_backchannel", "p_interruption", "p_none"))])


@registry.query("x27_canonical_labels", f"WITH {SQL_EVAL} SELECT CASE label WHEN 'interruption' THEN 'floor_taking' WHEN 'none' THEN 'silence' ELSE label END AS label, count(*) AS n FROM lab GROUP BY 1")
def x27_canonical_labels(spark, sf_dir):
    """Labels under their canonical names."""
    return evaluated(spark, sf_dir).groupBy(E.canonical_label(F.col("label")).alias("label")).agg(F.count("*").alias("n"))


@registry.query("a9_duration_percentiles", """WITH a AS (SELECT DISTINCT align_id, kind, start_sec, end_sec FROM alignment_turns), s AS (SELECT kind, end_sec - start_sec AS s FROM a WHERE end_sec >= start_sec)
SELECT kind, count(*) AS n, round(min(s), 6) AS least, round(max(s), 6) AS most, round(quantile_cont(s, 0.5), 6) AS median, round(quantile_cont(s, 0.9), 6) AS p90 FROM s GROUP BY kind""")
def a9_duration_percentiles(spark, sf_dir):
    """Durations of utterances and backchannels; percentiles are read off the ranks, so no task holds a kind's values."""
    from turnloom.operators.sampling import numbered

    a = table(spark, sf_dir, "alignment_turns").dropDuplicates(["align_id"]).where("end_sec >= start_sec").select("kind", (F.col("end_sec") - F.col("start_sec")).alias("s"))
    ranked = numbered(a, ["kind"], ["s"])

    def percentile(q):
        place = (F.col("n") - 1) * F.lit(q)
        low, high = (F.max(F.when(F.col("rn") == f(place), F.col("s"))) for f in (F.floor, F.ceil))
        return low + (high - low) * (F.max(place) - F.floor(F.max(place)))

    return ranked.groupBy("kind").agg(F.count("*").alias("n"), F.round(F.min("s"), 6).alias("least"), F.round(F.max("s"), 6).alias("most"), F.round(percentile(0.5), 6).alias("median"), F.round(percentile(0.9), 6).alias("p90"))


@registry.query("a12_rms_peak", "WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x FROM embeddings) SELECT vec_id, round(sqrt(avg(x * x)), 6) AS rms, round(max(abs(x)), 6) AS peak FROM v GROUP BY vec_id")
def a12_rms_peak(spark, sf_dir):
    """Root mean square and peak of each array, without leaving its row."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    ms = F.aggregate(e, F.lit(0.0), lambda s, x: s + x * x) / F.size("embedding")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(F.sqrt(ms), 6).alias("rms"), F.round(F.array_max(F.transform(e, F.abs)), 6).alias("peak"))


@registry.query("a12_loudness")
def a12_loudness(spark, sf_dir):
    """Integrated loudness of each vector, read as samples at so low a rate that they hold whole blocks, and the gain to -23."""
    from turnloom.operators import audio

    rows = table(spark, sf_dir, "embeddings").select("vec_id", audio.loudness(F.transform("embedding", lambda x: x.cast("double")), 40.0).alias("lufs"))
    return rows.select("vec_id", F.round("lufs", 6).alias("lufs"), F.round(audio.gain_to(F.col("lufs")), 6).alias("gain"))


@registry.query("m7_trimmed", "WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), l AS (SELECT vec_id, e, list_filter(range(1, len(e) + 1), lambda i: abs(e[i]) > 0.1) AS ks FROM e), t AS (SELECT vec_id, CASE WHEN len(ks) > 0 THEN e[list_min(ks):list_max(ks)] ELSE [] END AS t FROM l) SELECT vec_id, CAST(len(t) AS INTEGER) AS n, round(list_sum(t), 5) AS total, CAST(len(t) * 3 // 2 AS INTEGER) AS resampled, round(list_sum([t[CAST(floor(k * (2 / 3.0)) AS BIGINT) + 1] + (coalesce(t[CAST(floor(k * (2 / 3.0)) AS BIGINT) + 2], t[CAST(floor(k * (2 / 3.0)) AS BIGINT) + 1]) - t[CAST(floor(k * (2 / 3.0)) AS BIGINT) + 1]) * (k * (2 / 3.0) - floor(k * (2 / 3.0))) FOR k IN range(len(t) * 3 // 2)]), 4) AS resampled_total FROM t WHERE len(t) > 0")
def m7_trimmed(spark, sf_dir):
    """Arrays of samples without their quiet ends, and at one and a half times the rate."""
    from turnloom.operators import audio

    rows = table(spark, sf_dir, "embeddings").select("vec_id", audio.trimmed(F.transform("embedding", lambda x: x.cast("double")), 0.1).alias("t")).where("size(t) > 0")
    more = audio.resampled(F.col("t"), 2, 3)
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, b: a + b)
    return rows.select("vec_id", F.size("t").alias("n"), F.round(total(F.col("t")), 5).alias("total"), F.size(more).alias("resampled"), F.round(total(more), 4).alias("resampled_total"))


@registry.query("a13_batch_loss", f"WITH {SQL_EVAL}, l AS (SELECT CAST(pmod_ AS INTEGER) AS batch, CASE WHEN h1 > 0 THEN h1 * (ln(h1) - ln(q1)) ELSE 0 END + CASE WHEN h2 > 0 THEN h2 * (ln(h2) - ln(q2)) ELSE 0 END + CASE WHEN h3 > 0 THEN h3 * (ln(h3) - ln(q3)) ELSE 0 END AS loss FROM (SELECT *, (record_id % 16) AS pmod_ FROM ev)) SELECT batch, count(*) AS n, round(sum(loss) / count(*), 6) AS loss FROM l GROUP BY batch")
def a13_batch_loss(spark, sf_dir):
    """The mean loss of each batch of slots, from log-probabilities."""
    rows = P.t1_slots(spark, sf_dir).select((F.col("record_id") % 16).cast("int").alias("batch"), human().alias("h"), predicted().alias("q"))
    return E.batch_loss(rows, "batch", F.col("h"), F.transform("q", lambda x: F.log(x)))


@registry.query("a14_cosines", """WITH v AS (SELECT label, unnest(generate_series(1, len(embedding))) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings), m AS (SELECT label, list(m ORDER BY dim) AS m FROM (SELECT label, dim, avg(x) AS m FROM v GROUP BY ALL) GROUP BY label)
SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], m), 6) AS cosine FROM embeddings JOIN m USING (label)""")
def a14_cosines(spark, sf_dir):
    """How near each vector is to the mean of its label."""
    from turnloom.operators import audio

    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    mean = E.mean_embedding(rows, "label", "embedding").groupBy("label").agg(F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("m"))
    return rows.join(mean, "label").select("vec_id", F.round(audio.cosine(F.col("embedding"), F.col("m.value")), 6).alias("cosine"))


@registry.query("a14_speaker_embeddings", """WITH v AS (SELECT label, unnest(generate_series(0, len(embedding) - 1)) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings), m AS (SELECT label, dim, avg(x) AS m FROM v GROUP BY ALL)
SELECT label, CAST(dim AS INTEGER) AS dim, round(m / sqrt(sum(m * m) OVER (PARTITION BY label)), 6) AS value FROM m""")
def a14_speaker_embeddings(spark, sf_dir):
    """The mean vector of each label, scaled to length 1."""
    return E.mean_embedding(table(spark, sf_dir, "embeddings"), "label", "embedding").withColumn("value", F.round("value", 6))


@registry.query("w17_windows", "WITH v AS (SELECT vec_id, embedding, unnest(range(0, len(embedding), 8)) AS s FROM embeddings) SELECT vec_id, CAST(s // 8 AS INTEGER) AS window_no, round(list_sum(list_transform(embedding[s + 1:s + 16], lambda x: x::DOUBLE)), 5) AS total FROM v WHERE s = 0 OR len(embedding) - s >= 12")
def w17_windows(spark, sf_dir):
    """Overlapping windows over arrays, and their sums."""
    w = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(E.windows(F.col("embedding"), 16, 8)).alias("window_no", "w"))
    return w.select("vec_id", "window_no", F.round(F.aggregate(F.transform("w", lambda x: x.cast("double")), F.lit(0.0), lambda s, x: s + x), 5).alias("total"))

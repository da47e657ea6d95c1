"""Queries that profile tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import information, preparation, profile
from tidewatch.operators.ordering import quantiles
from tidewatch.plans import inputs
from tidewatch.plans.inputs import round6, sql6
from tidewatch.sources.logs import table_fingerprint

_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PART = ["p_size", "p_retailprice"]


def _items(spark, sf):
    return inputs.table(spark, sf, "lineitem").select(*_LINE, "l_returnflag")


def _gaps(spark, sf):
    """Line items with nulls and repeated rows."""
    items = inputs.table(spark, sf, "lineitem")
    return items.select(
        "l_linenumber", "l_returnflag",
        F.when(F.col("l_quantity") < 40, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_tax") > 0.01, F.col("l_tax")).alias("l_tax"), "l_discount",
    )


_GAPS_SQL = """gaps AS (SELECT l_linenumber, l_returnflag, CASE WHEN l_quantity < 40 THEN l_quantity END AS l_quantity,
  CASE WHEN l_tax > 0.01 THEN l_tax END AS l_tax, l_discount FROM lineitem)"""


def null_counts(spark, sf):
    return profile.null_counts(_gaps(spark, sf))


def duplicate_rows(spark, sf):
    return profile.duplicate_rows(_gaps(spark, sf))


def distinct_rows(spark, sf):
    return preparation.drop_duplicate_rows(_gaps(spark, sf))


def class_distribution(spark, sf):
    return profile.class_distribution(inputs.table(spark, sf, "lineitem"), "l_returnflag").withColumn("share", round6("share"))


def imbalance_ratio(spark, sf):
    return profile.imbalance_ratio(inputs.table(spark, sf, "lineitem"), "l_returnflag").withColumn("ratio", round6("ratio"))


def outlier_counts(spark, sf):
    """Event values and order prices are skewed; both are checked beyond three IQRs."""
    return profile.outlier_counts(inputs.events(spark, sf).select("value", (F.col("user_id") % 10).alias("shard")), ["value", "shard"])


def exact_quantiles(spark, sf):
    q = quantiles(_items(spark, sf), _LINE, [0.05, 0.25, 0.5, 0.75, 0.95])
    return q.select("feature", "prob", "n", round6("quantile").alias("quantile"))


def box_stats(spark, sf):
    b = profile.box_stats(inputs.events(spark, sf), ["value"])
    return b.select("feature", "n", "n_outside", *[round6(c).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")])


def histogram(spark, sf):
    h = profile.histogram(inputs.table(spark, sf, "part"), _PART)
    return h.select("feature", "bin", "n")


def describe(spark, sf):
    d = profile.describe(_items(spark, sf), _LINE)
    return d.select("feature", "n", "n_distinct", *[round6(c).alias(c) for c in ("mean", "std", "min", "q1", "median", "q3", "max")])


def variance_rank(spark, sf):
    return profile.variance_rank(inputs.table(spark, sf, "lineitem"), _LINE, 3).withColumn("variance", round6("variance"))


def imputed_medians(spark, sf):
    gaps = _gaps(spark, sf)
    filled = preparation.impute(gaps, preparation.fill_values(gaps, ["l_quantity", "l_tax"]))
    return filled.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), round6(F.avg("l_quantity")).alias("avg_quantity"), round6(F.avg("l_tax")).alias("avg_tax")
    )


def scaled_features(spark, sf):
    items = inputs.table(spark, sf, "part")
    scaled = preparation.scale(items, preparation.fit_scaler(items, _PART))
    return scaled.select("p_partkey", *[round6(c).alias(c) for c in _PART])


def scaled_minmax(spark, sf):
    items = inputs.table(spark, sf, "part")
    scaled = preparation.scale(items, preparation.fit_scaler(items, _PART, "minmax"))
    return scaled.select("p_partkey", *[round6(c).alias(c) for c in _PART])


def mutual_information(spark, sf):
    m = preparation.mutual_information(_items(spark, sf), _LINE, "l_returnflag", bins=8, approximate=False)
    return m.select("feature", round6("mutual_info").alias("mutual_info"))


_MEASURES = {"quantity": "l_quantity", "price": "round(l_extendedprice * 100)", "reduction": "round(l_discount * 100)"}


def neighbour_information(spark, sf):
    """What the measures of a line tell of its return flag, by nearest neighbours."""
    lines = inputs.table(spark, sf, "lineitem").select("l_returnflag", *[F.expr(e).cast("double").alias(c) for c, e in _MEASURES.items()])
    found = information.neighbour_information(lines, list(_MEASURES), "l_returnflag")
    return found.select("feature", F.floor(F.col("mutual_info") * 1e9 + 0.5).alias("mutual_info_e9"))


def flow_features(spark, sf):
    """Derived flow features, with an order line as a flow."""
    flows = inputs.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("total_fwd_packets"),
        (F.col("l_linenumber") - 1).cast("double").alias("total_bwd_packets"),
        F.col("l_extendedprice").alias("total_fwd_bytes"), (F.col("l_tax") * 1000).alias("total_bwd_bytes"),
        (F.col("l_discount") * 100).alias("flow_duration"), "l_returnflag",
    )
    wide = preparation.flow_features(flows).withColumn("label_binary", preparation.binary_label(F.col("l_returnflag"), "N"))
    names = [
        "total_packets", "total_bytes", "fwd_packet_len_mean", "bwd_packet_len_mean", "flow_bytes_per_sec",
        "flow_packets_per_sec", "down_up_ratio", "avg_packet_size", "avg_fwd_segment_size", "avg_bwd_segment_size",
    ]
    return wide.groupBy("label_binary").agg(*[round6(F.max(c)).alias(c) for c in names], F.count("*").alias("n"))


def class_weights(spark, sf):
    weighted = preparation.class_weights(inputs.table(spark, sf, "lineitem"), "l_returnflag")
    return weighted.groupBy("l_returnflag").agg(round6(F.max("weight")).alias("weight"), F.count("*").alias("n"))


def table_checksum(spark, sf):
    """An order-free fingerprint; a second reading in another partitioning must agree."""
    t = inputs.table(spark, sf, "lineitem")
    a, b = table_fingerprint(t), table_fingerprint(t.repartition(13, "l_partkey"))
    return a.join(b, ["n_rows", "fingerprint"]).select("n_rows")


QUERIES = {
    f.__name__: f
    for f in (
        null_counts, duplicate_rows, distinct_rows, class_distribution, imbalance_ratio, outlier_counts, exact_quantiles, box_stats,
        histogram, describe, variance_rank, imputed_medians, scaled_features, scaled_minmax, mutual_information, neighbour_information,
        flow_features, class_weights, table_checksum,
    )
}


def _each(columns, template, sep=" UNION ALL "):
    return sep.join(template.replace("{c}", c) for c in columns)


_MI_EDGES = ", ".join(f"quantile_cont({{c}}, {i / 8}) AS e{i}" for i in range(1, 8))
# equal edges count once
_MI_BIN = " + ".join(
    f"CAST({{c}} > e{i} AND " + ("true" if i == 1 else f"e{i} <> e{i - 1}") + " AS INT)" for i in range(1, 8)
)
_FLOW = """SELECT CASE WHEN l_returnflag = 'N' THEN 'Benign' ELSE 'Attack' END AS label_binary,
  l_quantity AS fp, l_linenumber - 1 AS bp, l_extendedprice AS fb, l_tax * 1000 AS bb, l_discount * 100 AS dur FROM lineitem"""

ORACLES = {
    "imbalance_ratio": f"""SELECT max(n) AS largest, min(n) AS smallest, {sql6('max(n) / min(n)')} AS ratio
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_returnflag)""",
    "null_counts": f"WITH {_GAPS_SQL} " + _each(
        ["l_linenumber", "l_returnflag", "l_quantity", "l_tax", "l_discount"],
        "SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_nulls FROM gaps",
    ),
    "duplicate_rows": f"WITH {_GAPS_SQL}, g AS (SELECT count(*) AS n FROM gaps GROUP BY l_linenumber, l_returnflag, l_quantity, l_tax, l_discount) "
    "SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(n - 1) AS BIGINT) AS n_repeats FROM g",
    "distinct_rows": f"WITH {_GAPS_SQL} SELECT DISTINCT * FROM gaps",
    "class_distribution": f"SELECT l_returnflag AS label, count(*) AS n_rows, {sql6('count(*) / (SELECT count(*) FROM lineitem)')} AS share FROM lineitem GROUP BY 1",
    "outlier_counts": """WITH v AS (SELECT value, user_id % 10 AS shard FROM events),
        q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, quantile_cont(shard, 0.25) AS c, quantile_cont(shard, 0.75) AS d FROM v)
        SELECT 'value' AS feature, count(*) FILTER (value < a - 3 * (b - a) OR value > b + 3 * (b - a)) AS n_outliers FROM v, q
        UNION ALL SELECT 'shard', count(*) FILTER (shard < c - 3 * (d - c) OR shard > d + 3 * (d - c)) FROM v, q""",
    "exact_quantiles": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({p} AS DOUBLE) AS prob, count({c}) AS n, {sql6(f'quantile_cont({c}, {p})')} AS quantile FROM lineitem"
        for c in _LINE for p in (0.05, 0.25, 0.5, 0.75, 0.95)
    ),
    "box_stats": f"""WITH q AS (SELECT count(value) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM events),
        v AS (SELECT value, q.*, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM events, q)
        SELECT 'value' AS feature, n, count(*) FILTER (NOT inside) AS n_outside, {sql6('q1')} AS q1, {sql6('median')} AS median, {sql6('q3')} AS q3,
        {sql6('min(value) FILTER (inside)')} AS whisker_low, {sql6('max(value) FILTER (inside)')} AS whisker_high FROM v GROUP BY n, q1, median, q3""",
    "histogram": "WITH bins AS (SELECT CAST(unnest(range(12)) AS INTEGER) AS bin), " + ", ".join(
        f"""r_{c} AS (SELECT min({c}) AS lo, max({c}) AS hi FROM part),
        h_{c} AS (SELECT CAST(least(floor(({c} - lo) / CAST(hi - lo AS DOUBLE) * 12), 11) AS INTEGER) AS bin, count(*) AS n FROM part, r_{c} GROUP BY 1)"""
        for c in _PART
    ) + " " + " UNION ALL ".join(f"SELECT '{c}' AS feature, bin, coalesce(n, 0) AS n FROM bins LEFT JOIN h_{c} USING (bin)" for c in _PART),
    "describe": " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS n, count(DISTINCT {c}) AS n_distinct, {sql6(f'avg({c})')} AS mean, {sql6(f'stddev_samp({c})')} AS std,
        {sql6(f'min({c})')} AS min, {sql6(f'quantile_cont({c}, 0.25)')} AS q1, {sql6(f'quantile_cont({c}, 0.5)')} AS median,
        {sql6(f'quantile_cont({c}, 0.75)')} AS q3, {sql6(f'max({c})')} AS max FROM lineitem"""
        for c in _LINE
    ),
    "variance_rank": "SELECT feature, " + sql6("v") + " AS variance FROM (" + _each(_LINE, "SELECT '{c}' AS feature, var_samp({c}) AS v FROM lineitem") + ") ORDER BY v DESC LIMIT 3",
    "imputed_medians": f"""WITH {_GAPS_SQL}, m AS (SELECT quantile_cont(l_quantity, 0.5) AS q, quantile_cont(l_tax, 0.5) AS t FROM gaps)
        SELECT l_returnflag, count(*) AS n, {sql6('avg(coalesce(l_quantity, q))')} AS avg_quantity, {sql6('avg(coalesce(l_tax, t))')} AS avg_tax FROM gaps, m GROUP BY 1""",
    "scaled_features": "SELECT p_partkey, " + ", ".join(f"{sql6(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()')} AS {c}" for c in _PART) + " FROM part",
    "scaled_minmax": "SELECT p_partkey, " + ", ".join(f"{sql6(f'({c} - min({c}) OVER ()) / CAST(max({c}) OVER () - min({c}) OVER () AS DOUBLE)')} AS {c}" for c in _PART) + " FROM part",
    "neighbour_information": """WITH v AS (SELECT l_returnflag AS y, unnest(['quantity', 'price', 'reduction']) AS feature,
          unnest([CAST(l_quantity AS DOUBLE), round(l_extendedprice * 100), round(l_discount * 100)]) AS x FROM lineitem),
        c AS (SELECT feature, y, x, count(*) AS n FROM v GROUP BY ALL), s AS (SELECT feature, y, sum(n) AS cn FROM c GROUP BY ALL),
        around AS (SELECT feature, y, x, n, unnest([0.0, x - lag(x, 1) OVER w, x - lag(x, 2) OVER w, x - lag(x, 3) OVER w, lead(x, 1) OVER w - x, lead(x, 2) OVER w - x, lead(x, 3) OVER w - x]) AS d,
          unnest([n - 1, lag(n, 1) OVER w, lag(n, 2) OVER w, lag(n, 3) OVER w, lead(n, 1) OVER w, lead(n, 2) OVER w, lead(n, 3) OVER w]) AS m FROM c WINDOW w AS (PARTITION BY feature, y ORDER BY x)),
        cum AS (SELECT *, sum(m) OVER (PARTITION BY feature, y, x ORDER BY d ROWS UNBOUNDED PRECEDING) AS reached FROM around WHERE d IS NOT NULL),
        r AS (SELECT feature, y, x, n, min(d) FILTER (reached >= 3) AS d FROM cum GROUP BY ALL),
        p AS (SELECT feature, x, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY feature ORDER BY x) AS cum FROM c GROUP BY feature, x),
        m AS (SELECT r.feature, r.y, r.n, CASE WHEN r.d = 0 THEN r.n ELSE 3 END AS k, CAST(CASE WHEN r.d = 0 THEN e.n ELSE hi.cum - coalesce(lo.cum, 0) END AS BIGINT) AS m FROM r JOIN p e ON r.feature = e.feature AND r.x = e.x
          ASOF JOIN p hi ON r.feature = hi.feature AND r.x + r.d + CASE WHEN r.d = 0 THEN 1 ELSE 0 END > hi.x ASOF LEFT JOIN p lo ON r.feature = lo.feature AND r.x - r.d >= lo.x),
        h AS (SELECT i + 1 AS n, sum(1.0::DOUBLE / i) OVER (ORDER BY i) - 0.5772156649015329::DOUBLE AS psi FROM range(1, (SELECT count(*) + 1 FROM lineitem)) t(i)
          UNION ALL SELECT 1, -0.5772156649015329::DOUBLE)
        SELECT m.feature, CAST(floor(greatest(0, max(a.psi) + sum(m.n * (hk.psi - hc.psi - hm.psi)) / sum(m.n)) * 1e9 + 0.5) AS BIGINT) AS mutual_info_e9
        FROM m JOIN s USING (feature, y) JOIN h hc ON hc.n = s.cn JOIN h hm ON hm.n = m.m JOIN h hk ON hk.n = m.k JOIN h a ON a.n = (SELECT count(*) FROM lineitem) GROUP BY m.feature""",
    "mutual_information": "WITH " + ", ".join(
        f"""b_{c} AS (SELECT {_MI_BIN.replace('{c}', c)} AS b, l_returnflag AS y FROM lineitem, (SELECT {_MI_EDGES.replace('{c}', c)} FROM lineitem)),
        c_{c} AS (SELECT b, y, count(*) AS n FROM b_{c} GROUP BY 1, 2),
        s_{c} AS (SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY b) AS nb, sum(n) OVER (PARTITION BY y) AS ny FROM c_{c})"""
        for c in _LINE
    ) + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {sql6('sum(n / t * ln(n * t / (nb * ny)))')} AS mutual_info FROM s_{c}" for c in _LINE
    ),
    "flow_features": f"""WITH f AS ({_FLOW}) SELECT label_binary, {sql6('max(fp + bp)')} AS total_packets, {sql6('max(fb + bb)')} AS total_bytes,
        {sql6('max(fb / greatest(fp, 1))')} AS fwd_packet_len_mean, {sql6('max(bb / greatest(bp, 1))')} AS bwd_packet_len_mean,
        {sql6('max((fb + bb) / greatest(dur, 1) * 1e6)')} AS flow_bytes_per_sec, {sql6('max((fp + bp) / greatest(dur, 1) * 1e6)')} AS flow_packets_per_sec,
        {sql6('max(bb / greatest(fb, 1))')} AS down_up_ratio, {sql6('max((fb + bb) / greatest(fp + bp, 1))')} AS avg_packet_size,
        {sql6('max(fb / greatest(fp, 1))')} AS avg_fwd_segment_size, {sql6('max(bb / greatest(bp, 1))')} AS avg_bwd_segment_size,
        count(*) AS n FROM f GROUP BY 1""",
    "class_weights": f"""WITH c AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1)
        SELECT l_returnflag, {sql6('(SELECT count(*) FROM lineitem) / CAST(n * (SELECT count(*) FROM c) AS DOUBLE)')} AS weight, n FROM c""",
    "table_checksum": "SELECT count(*) AS n_rows FROM lineitem",
}

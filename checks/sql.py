"""SQL that must give the rows of ``queries.py`` on the same tables, in the dialect of DuckDB."""

from __future__ import annotations

from collections.abc import Sequence

# Shapes of the given tables, see ``views.py``.
SHAPES = {
    "trips": """SELECT event_id AS id, (event_id % 2 + 1)::INTEGER AS vendor_id, date_trunc('second', ts) AS picked,
        (event_id * 7 % 9)::INTEGER AS passenger_count,
        (user_id * 37 % 100) / 1e3 - 74.05::DOUBLE AS pickup_longitude,
        (user_id * 53 % 100) / 5e2 + 40.6::DOUBLE AS pickup_latitude,
        (event_id * 41 % 100) / 1e3 - 74.05::DOUBLE AS dropoff_longitude,
        (event_id * 29 % 100) / 1e3 + 40.6::DOUBLE AS dropoff_latitude,
        CASE WHEN event_type = 'view' THEN 'Y' ELSE 'N' END AS flag,
        (floor(value)::BIGINT + 9 * (event_id * 41 % 100) + 11 * hour(ts))::INTEGER AS trip_duration
        FROM events""",
    "cards": """SELECT event_id, value / 1e2 AS amount, hour(ts) / 2.4e1 AS hour_share,
        CASE WHEN (event_id * 7919 % 1000) / 1e3 < 1 / (1 + exp(1.5 - value / 5e1)) THEN 1.0 ELSE 0.0 END::DOUBLE AS label
        FROM events""",
    "prices": """SELECT l_orderkey, l_quantity, l_discount, l_tax, l_linenumber,
        round(l_extendedprice * 100)::BIGINT AS cents FROM lineitem""",
    "returns": """SELECT l_orderkey, l_quantity / 5e1 AS quantity, l_discount AS discount,
        CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS returned,
        CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END::DOUBLE AS guess, l_extendedprice AS score FROM lineitem""",
    "docs": """SELECT doc_id, (length(text) - length(replace(text, chr(10), '')) + 1)::INTEGER AS n_lines,
        (length(text) - length(replace(text, ' ', '')) + 1)::INTEGER AS n_words,
        length(source)::INTEGER AS source_length, n_chars FROM documents""",
    "guesses": """SELECT o_orderkey, o_custkey, o_totalprice AS label,
        month(o_orderdate) * 2e4 + (o_custkey % 7) * 3e4 AS prediction FROM orders""",
    "points": """SELECT c_custkey, (c_custkey * 37 % 360 - 180)::DOUBLE AS lon1, (c_custkey * 53 % 180 - 90)::DOUBLE AS lat1,
        (c_custkey * 41 % 360 - 180)::DOUBLE AS lon2, (c_custkey * 29 % 180 - 90)::DOUBLE AS lat2 FROM customer""",
    "gaps": """SELECT l_orderkey, nullif(l_quantity, 13.0) AS quantity, nullif(l_discount, 0.05) AS discount,
        nullif(l_linestatus, 'F') AS status, l_extendedprice FROM lineitem""",
}
PRICE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
DOC_FEATURES = ["n_lines", "n_words", "source_length"]
HOUR_FEATURES = ["vendor_id", "pickup_hour", "passenger_count"]
TRIP_FEATURES = [
    "vendor_id", "pickup_year", "pickup_month", "pickup_day", "pickup_hour", "pickup_min", "pickup_sec", "passenger_count",
    "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude", "store_and_fwd_flag", "distance_km",
]


def query(select: str, *ctes: str) -> str:
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + select


def shape(name: str) -> str:
    return f"{name} AS ({SHAPES[name]})"


def in_train(key: str, share: float = 0.8) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', '24', {key}::VARCHAR)), 1, 8))::BIGINT < {round(share * 2**32)})"


def km(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    chord = (
        f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))"
    )
    return f"coalesce(6371 * 2 * atan2(sqrt({chord}), sqrt(greatest(1 - {chord}, 0.0::DOUBLE))), 0.0)"


FEATURED = f"""featured AS (SELECT id, vendor_id, year(picked)::INTEGER AS pickup_year, month(picked)::INTEGER AS pickup_month,
    day(picked)::INTEGER AS pickup_day, hour(picked)::INTEGER AS pickup_hour, minute(picked)::INTEGER AS pickup_min,
    second(picked)::INTEGER AS pickup_sec, passenger_count, pickup_longitude, pickup_latitude, dropoff_longitude,
    dropoff_latitude, CASE WHEN flag = 'Y' THEN 1 ELSE 0 END::INTEGER AS store_and_fwd_flag,
    {km("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")} AS distance_km, trip_duration
    FROM trips)"""
KEPT = """trip_duration > 0 AND trip_duration < 36000 AND passenger_count >= 1 AND passenger_count <= 6
    AND distance_km > 0 AND distance_km < 100"""


# Trees. The source has the features, ``y`` and ``fit`` (true for training rows); level d is the relation ``l<d>``.

GAIN = "(ln * (tn - ln) / (tn * tn)) * ((ls / ln - (ts - ls) / (tn - ln)) * (ls / ln - (ts - ls) / (tn - ln)))"


def tree_ctes(
    source: str, features: Sequence[str], depth: int, start: str = "1::BIGINT", real: bool = False, categorical: Sequence[str] = ()
) -> list[str]:
    """Levels of the exact tree. ``real`` labels are centred in ``yc``, and their gains compared to 12 digits.

    The values of a ``categorical`` feature stand in the order of their means, and a split is the bits of the first of them.
    """
    y = "yc" if real else "y"
    middle = f", y - (SELECT avg(y) FROM {source} WHERE fit) AS yc" if real else ""
    by_size = "floor(log10(gain)) DESC, round(gain * pow(10, 11 - floor(log10(gain)))) DESC" if real else "gain DESC"
    is_set = f"feature IN ({', '.join(str(features.index(c)) for c in categorical) or '-1'})"
    ctes = [f"l0 AS (SELECT *, {start} AS node{middle} FROM {source})"]
    for d in range(depth):
        long = " UNION ALL ".join(
            f"SELECT node, {i} AS feature, {f}::DOUBLE AS value, {y} AS y FROM l{d} WHERE fit AND node >= {2**d}"
            for i, f in enumerate(features)
        )
        pick = " ".join(
            f"WHEN {i} THEN ((b.subset >> {f}::BIGINT) & 1) = 1" if f in categorical else f"WHEN {i} THEN {f}::DOUBLE <= b.threshold"
            for i, f in enumerate(features)
        )
        ctes += [
            f"""v{d} AS (SELECT node, feature, value, count(*) AS n, sum(y) AS s,
                CASE WHEN {is_set} THEN sum(y)::DOUBLE / count(*) END AS spot FROM ({long})
                GROUP BY node, feature, value)""",
            f"""r{d} AS (SELECT node, feature, value, lead(value) OVER o AS nv, (sum(n) OVER o)::DOUBLE AS ln,
                (sum(s) OVER o)::DOUBLE AS ls, (sum(n) OVER p)::DOUBLE AS tn, (sum(s) OVER p)::DOUBLE AS ts,
                CASE WHEN {is_set} THEN (sum(CASE WHEN {is_set} THEN 1::BIGINT << value::BIGINT END) OVER o)::BIGINT END AS subset,
                (row_number() OVER o)::DOUBLE AS nth FROM v{d}
                WINDOW o AS (PARTITION BY node, feature ORDER BY spot, value), p AS (PARTITION BY node, feature))""",
            f"""g{d} AS (SELECT node, feature, CASE WHEN NOT {is_set} THEN (value + nv) / 2 END AS threshold, subset,
                CASE WHEN {is_set} THEN nth ELSE (value + nv) / 2 END AS place, {GAIN} AS gain
                FROM r{d} WHERE nv IS NOT NULL)""",
            f"""m{d} AS (SELECT node, min({y}) AS lowest, max({y}) AS highest, var_pop({y}) AS variance
                FROM l{d} WHERE fit AND node >= {2**d} GROUP BY node)""",
            f"""b{d} AS (SELECT g.* FROM g{d} g JOIN m{d} USING (node)
                WHERE gain > 0 AND lowest < highest AND gain > 1e-12 * variance
                QUALIFY row_number() OVER (PARTITION BY node ORDER BY {by_size}, feature, place) = 1)""",
            f"""l{d + 1} AS (SELECT l.* EXCLUDE (node), CASE WHEN b.node IS NULL THEN l.node
                WHEN (CASE b.feature {pick} END) THEN 2 * l.node ELSE 2 * l.node + 1 END AS node
                FROM l{d} l LEFT JOIN b{d} b ON l.node = b.node)""",
        ]
    return ctes


def model_cte(depth: int, subsets: bool = False) -> str:
    own = ["feature", "threshold", "gain", *(["subset"] if subsets else [])]
    parts = []
    for d in range(depth + 1):
        stats = f"SELECT node, count(*) AS n, sum(y)::DOUBLE / count(*) AS mean FROM l{d} WHERE fit AND node >= {2**d} GROUP BY node"
        best = f"LEFT JOIN b{d} b USING (node)" if d < depth else ""
        cols = ", ".join(f"b.{c}" if d < depth else "NULL" for c in own)
        parts.append(f"SELECT node, {d} AS depth, {cols}, n, mean FROM ({stats}) {best}")
    return f"model(node_id, depth, {', '.join(own)}, n, prediction) AS (" + " UNION ALL ".join(parts) + ")"


def leaf_means(depth: int, name: str = "leaf") -> str:
    return f"{name} AS (SELECT node, avg(y) AS mean FROM l{depth} WHERE fit GROUP BY node)"


MODEL_COLUMNS = """SELECT node_id, depth::INTEGER AS depth, feature::INTEGER AS feature, threshold::DOUBLE AS threshold,
    round(gain::DOUBLE, 2) AS gain, n::BIGINT AS n, round(prediction, 4) AS prediction FROM model"""
PRICE_SOURCE = "source AS (SELECT *, cents AS y, true AS fit FROM prices)"
DOC_SOURCE = "source AS (SELECT *, n_chars AS y, true AS fit FROM docs)"
TRIP_SOURCE = f"source AS (SELECT *, trip_duration AS y, {in_train('id')} AS fit FROM featured WHERE {KEPT})"
PRICE_TREE = [shape("prices"), PRICE_SOURCE, *tree_ctes("source", PRICE_FEATURES, 2)]
# Test trips are scored but neither filtered nor fitted.
LOG_TRIPS = [
    shape("trips"), FEATURED,
    f"""source AS (SELECT *, ln(1 + trip_duration) AS y, {KEPT} AND {in_train('id')} AS fit,
        {KEPT} AND NOT {in_train('id')} AS held_out FROM featured)""",
    *tree_ctes("source", TRIP_FEATURES, 5, real=True),
    leaf_means(5),
]
LOG_DOC_SOURCE = "source AS (SELECT *, ln(1 + n_chars // 500) AS y, true AS fit FROM docs)"
LOG_DOCS = [shape("docs"), LOG_DOC_SOURCE, *tree_ctes("source", DOC_FEATURES, 5, real=True), model_cte(5)]
DEEP_DOCS = [shape("docs"), DOC_SOURCE, *tree_ctes("source", DOC_FEATURES, 10), model_cte(10)]


def shares(source: str, split: bool = False) -> str:
    """Accuracy, precision and recall rows of ``source`` with ``y`` and ``p`` (and ``split``)."""
    head, tail = ("split, ", " GROUP BY split") if split else ("", "")

    def row(metric: str, label: str, part: str, whole: str) -> str:
        return (
            f"SELECT {head}'{metric}' AS metric, {label}::DOUBLE AS label,"
            f" coalesce(count_if({part}) / nullif(count_if({whole}), 0), 0.0)::DOUBLE AS value FROM {source}{tail}"
        )

    rows = [row("accuracy", "NULL", "y = p", "true")]
    for k in (0, 1):
        rows.append(row("precision", str(k), f"y = {k} AND p = {k}", f"p = {k}"))
        rows.append(row("recall", str(k), f"y = {k} AND p = {k}", f"y = {k}"))
    return " UNION ALL ".join(rows)


def area(source: str, score: str, by: str = "") -> str:
    """AUC of ``source`` with ``y``, counting ties half."""
    head, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    return f"""SELECT {head}sum(pos * (cn - neg / 2)) / (sum(pos) * sum(neg)) AS auc FROM (
        SELECT *, sum(neg) OVER ({part}ORDER BY s) AS cn FROM (
            SELECT {head}{score} AS s, count_if(y = 1)::DOUBLE AS pos, count_if(y = 0)::DOUBLE AS neg
            FROM {source} GROUP BY ALL)){f" GROUP BY {by}" if by else ""}"""


def report(source: str, digits: int) -> str:
    """The report of ``source`` with ``split``, ``y``, hard ``p`` and score ``s``."""
    areas = " UNION ALL ".join(
        f"SELECT split, '{name}' AS metric, NULL::DOUBLE AS label, auc AS value FROM ({area(source, score, 'split')})"
        for name, score in (("auc_hard", "p"), ("auc", "s"))
    )
    return f"SELECT split, metric, label, round(value, {digits}) AS value FROM ({shares(source, True)} UNION ALL {areas})"


# Logistic regression over ``source`` with two features ``a``, ``b`` and ``y``; weights are the one-row relations ``w<i>``.

CHANCE = "1 / (1 + exp(-(a * wa + b * wb + wc)))"


def descent(source: str, step: float, iterations: int) -> list[str]:
    ctes = ["w0 AS (SELECT 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, 0.0::DOUBLE AS wc)"]
    for i in range(iterations):
        ctes.append(
            f"""w{i + 1} AS (SELECT wa - {step!r} * ga AS wa, wb - {step!r} * gb AS wb, wc - {step!r} * gc AS wc
            FROM w{i}, (SELECT sum(({CHANCE} - y) * a) AS ga, sum(({CHANCE} - y) * b) AS gb, sum({CHANCE} - y) AS gc
            FROM {source}, w{i}))"""
        )
    return ctes


def newton(source: str, iterations: int = 12) -> list[str]:
    """Newton steps with the 3 × 3 system solved by determinants."""
    ctes = ["w0 AS (SELECT 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, 0.0::DOUBLE AS wc)"]
    for i in range(iterations):
        ctes += [
            f"p{i} AS (SELECT a, b, y, {CHANCE} AS p FROM {source}, w{i})",
            f"""h{i} AS (SELECT sum((p - y) * a) AS g1, sum((p - y) * b) AS g2, sum(p - y) AS g3,
                sum(p * (1 - p) * a * a) AS aa, sum(p * (1 - p) * a * b) AS ab, sum(p * (1 - p) * a) AS ac,
                sum(p * (1 - p) * b * b) AS bb, sum(p * (1 - p) * b) AS bc, sum(p * (1 - p)) AS cc FROM p{i})""",
            f"""d{i} AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det
                FROM h{i})""",
            f"""w{i + 1} AS (SELECT
                wa - (g1 * (bb * cc - bc * bc) - ab * (g2 * cc - bc * g3) + ac * (g2 * bc - bb * g3)) / det AS wa,
                wb - (aa * (g2 * cc - bc * g3) - g1 * (ab * cc - bc * ac) + ac * (ab * g3 - g2 * ac)) / det AS wb,
                wc - (aa * (bb * g3 - g2 * bc) - ab * (ab * g3 - g2 * ac) + g1 * (ab * bc - bb * ac)) / det AS wc
                FROM w{i}, d{i})""",
        ]
    return ctes


def terms(weights: str, a: str, b: str, digits: int, column: str = "value") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS term, round({w}, {digits}) AS {column} FROM {weights}"
        for name, w in ((a, "wa"), (b, "wb"), ("intercept", "wc"))
    )


RETURN_SOURCE = "source AS (SELECT quantity AS a, discount AS b, returned AS y FROM returns)"
CARD_SOURCE = f"""source AS (SELECT amount AS a, hour_share AS b, label AS y,
    CASE WHEN {in_train('event_id')} THEN 'train' ELSE 'test' END AS split FROM cards)"""
CARD_TRAIN = "train AS (SELECT * FROM source WHERE split = 'train')"
# z-scores with the statistics of the training part.
CARD_SCALED = """scaled AS (SELECT (a - ma) / sa AS a, (b - mb) / sb AS b, y, split FROM source,
    (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb FROM source WHERE split = 'train'))"""


def scored(source: str, weights: str) -> str:
    return f"""scored AS (SELECT split, y, {CHANCE} AS s, CASE WHEN {CHANCE} >= 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS p
        FROM {source}, {weights})"""


REGRESSION = "count(*) AS n, sqrt(avg(pow(prediction - label, 2))) AS rmse, 1 - avg(pow(prediction - label, 2)) / var_pop(label) AS r2"

ORACLES: dict[str, str] = {
    "csv_roundtrip": "SELECT event_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events",
    "labelled_scan": query(
        "SELECT event_id::DOUBLE AS event_id, round(amount, 9) AS amount, round(hour_share, 9) AS hour_share, label FROM cards",
        shape("cards"),
    ),
    "preview_rows": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
    "score_table": query(
        "SELECT id, round(mean, 6) AS trip_duration FROM l2 JOIN leaf USING (node)",
        shape("trips"), FEATURED, f"source AS (SELECT *, trip_duration AS y, {KEPT} AS fit FROM featured)",
        *tree_ctes("source", HOUR_FEATURES, 2), leaf_means(2),
    ),
    "trip_features": query(
        """SELECT * EXCLUDE (distance_km, pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude),
        round(distance_km, 6) AS distance_km, round(pickup_longitude, 6) AS pickup_longitude,
        round(pickup_latitude, 6) AS pickup_latitude, round(dropoff_longitude, 6) AS dropoff_longitude,
        round(dropoff_latitude, 6) AS dropoff_latitude FROM featured""",
        shape("trips"), FEATURED,
    ),
    "parse_timestamp": """SELECT event_id, CASE WHEN event_type NOT IN ('error', 'view') THEN date_trunc('second', ts) END AS at
        FROM events""",
    "calendar_parts": """SELECT event_id, year(ts)::INTEGER AS at_year, month(ts)::INTEGER AS at_month,
        day(ts)::INTEGER AS at_day, hour(ts)::INTEGER AS at_hour, minute(ts)::INTEGER AS at_min,
        second(ts)::INTEGER AS at_sec FROM events""",
    "flag_encode": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END::INTEGER AS closed FROM orders",
    "great_circle": query(
        f"SELECT c_custkey, round({km('lon1', 'lat1', 'nullif(lon2, 0)', 'lat2')}, 6) AS km FROM points", shape("points")
    ),
    "category_index": """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0.0 WHEN '2-HIGH' THEN 1.0
        WHEN '3-MEDIUM' THEN 2.0 WHEN '4-NOT SPECIFIED' THEN 3.0 END::DOUBLE AS priority FROM orders""",
    "assemble_features": """SELECT p_partkey, p_size::DOUBLE AS a0, p_retailprice AS a1, p_size::DOUBLE AS v0,
        p_retailprice AS v1 FROM part WHERE p_size <> 7""",
    "log_label": "SELECT p_partkey, round(ln(1 + p_retailprice), 6) AS logged, round(p_retailprice, 6) AS back FROM part",
    "zscore": query(
        """SELECT p_partkey, round((p_size - m1) / s1, 6) AS p_size, round((p_retailprice - m2) / s2, 6) AS p_retailprice
        FROM part, stats""",
        f"""stats AS (SELECT avg(p_size) AS m1, stddev_pop(p_size) AS s1, avg(p_retailprice) AS m2,
        stddev_pop(p_retailprice) AS s2 FROM part WHERE {in_train('p_partkey')})""",
    ),
    "linear_score": query(
        "SELECT round(p, 9) AS probability, CASE WHEN p >= 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction, count(*) AS n"
        " FROM (SELECT 1 / (1 + exp(-(quantity * 1.5e0 + discount * -2e1 + 2.5e-1))) AS p FROM returns) GROUP BY ALL",
        shape("returns"),
    ),
    "range_filter": query(
        """SELECT l_orderkey, quantity, discount, l_extendedprice FROM gaps WHERE quantity BETWEEN 5 AND 40
        AND discount > 0 AND discount < 0.08 AND l_extendedprice >= 5000 AND l_extendedprice < 90000""",
        shape("gaps"),
    ),
    "null_profile": query(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count_if({c} IS NULL)::BIGINT AS null_count FROM gaps"
            for c in ("l_orderkey", "quantity", "discount", "status", "l_extendedprice")
        ),
        shape("gaps"),
    ),
    "drop_nulls": query(
        """SELECT status, quantity, count(*) AS n FROM gaps WHERE quantity IS NOT NULL AND discount IS NOT NULL
        AND status IS NOT NULL GROUP BY ALL""",
        shape("gaps"),
    ),
    "hash_split": f"""SELECT CASE WHEN {in_train('l_orderkey')} THEN 'train' ELSE 'test' END AS part, l_linenumber,
        count(*) AS n, sum(l_orderkey)::BIGINT AS keys FROM lineitem GROUP BY ALL""",
    "join_predictions": query("SELECT o_orderkey, prediction, label FROM guesses", shape("guesses")),
    "joined_metrics": query(
        """SELECT count(*) AS n, round(sqrt(avg(pow(p.prediction - y.label, 2))), 4) AS rmse,
        round(1 - sum(pow(p.prediction - y.label, 2)) / (SELECT var_pop(label) * count(label) FROM guesses), 9) AS r2
        FROM guesses p JOIN guesses y USING (o_custkey)""",
        shape("guesses"),
    ),
    "confusion_counts": query(
        "SELECT returned AS label, guess AS prediction, count(*) AS n FROM returns GROUP BY ALL", shape("returns")
    ),
    "class_metrics": query(
        f"SELECT metric, label, round(value, 9) AS value FROM ({shares('source')})",
        shape("returns"), "source AS (SELECT returned AS y, guess AS p FROM returns)",
    ),
    "regression_metrics": query(
        f"SELECT n, round(rmse, 4) AS rmse, round(r2, 9) AS r2 FROM (SELECT {REGRESSION} FROM guesses)", shape("guesses")
    ),
    "feature_moments": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) AS n, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    )
    + " UNION ALL SELECT 'same' AS feature, count(*) AS n, 5.0::DOUBLE AS mean, 1.0::DOUBLE AS std FROM lineitem",
    "tie_ranks": """SELECT value, n, (cn - (n - 1) / 2)::DOUBLE AS avg_rank FROM (
        SELECT value, n, sum(n) OVER (ORDER BY value)::DOUBLE AS cn FROM (
            SELECT value, count(*) AS n FROM events GROUP BY value))""",
    "prefix_sums": """SELECT l_returnflag, l_extendedprice, n, lines, (sum(n) OVER w)::BIGINT AS cum_n,
        (sum(lines) OVER w)::BIGINT AS cum_lines, lead(l_extendedprice) OVER w AS next_value FROM (
            SELECT l_returnflag, l_extendedprice, count(*) AS n, sum(l_linenumber)::BIGINT AS lines
            FROM lineitem GROUP BY ALL)
        WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_extendedprice)""",
    "auc_rank": query(
        f"SELECT round(auc, 9) AS auc FROM ({area('source', 'score')})",
        shape("returns"), "source AS (SELECT *, returned AS y FROM returns)",
    ),
    "metric_report": query(
        report("source", 9),
        shape("returns"),
        f"""source AS (SELECT CASE WHEN {in_train('l_orderkey')} THEN 'train' ELSE 'test' END AS split,
        returned AS y, guess AS p, score AS s FROM returns)""",
    ),
    "metric_delta": query(
        """SELECT g.metric, round(g.value, 4) AS value, round(f.value, 4) AS baseline, round(g.value - f.value, 4) AS delta
        FROM (UNPIVOT g ON rmse, r2 INTO NAME metric VALUE value) g
        JOIN (UNPIVOT f ON rmse, r2 INTO NAME metric VALUE value) f USING (metric)""",
        shape("guesses"),
        f"g AS (SELECT * EXCLUDE (n) FROM (SELECT {REGRESSION} FROM guesses))",
        f"f AS (SELECT * EXCLUDE (n) FROM (SELECT {REGRESSION} FROM (SELECT label, 2.5e5 AS prediction FROM guesses)))",
    ),
    "node_stats": query(
        """SELECT node, count(*) AS n, sum(cents)::BIGINT AS total, round(avg(cents), 4) AS mean,
        round(var_pop(cents), 0) AS variance, min(cents) AS lowest, max(cents) AS highest
        FROM (SELECT *, CASE WHEN l_linenumber <= 3 THEN 2 ELSE 3 END::BIGINT AS node FROM prices) GROUP BY node""",
        shape("prices"),
    ),
    "best_split": query(
        "SELECT node, feature::INTEGER AS feature, threshold, round(gain, 2) AS gain FROM b0",
        shape("prices"), PRICE_SOURCE,
        *tree_ctes("source", PRICE_FEATURES, 1, "CASE WHEN l_linenumber <= 3 THEN 2 ELSE 3 END::BIGINT"),
    ),
    "tree_exact": query(MODEL_COLUMNS, *PRICE_TREE, model_cte(2)),
    "tree_exact_documents": query(
        MODEL_COLUMNS, shape("docs"), DOC_SOURCE, *tree_ctes("source", DOC_FEATURES, 4), model_cte(4)
    ),
    "tree_score": query(
        """SELECT round(avg(y), 4) AS prediction, count(*) AS n, sum(y)::BIGINT AS cents FROM l2 GROUP BY node""", *PRICE_TREE
    ),
    "tree_rules": query(
        """SELECT node_id, depth::INTEGER AS depth, repeat(' ', 4 * depth) || rule AS rule FROM (
            SELECT node_id, depth, printf('If feature[%d] <= %.2f', feature, threshold) AS rule
            FROM model WHERE feature IS NOT NULL
            UNION ALL SELECT node_id, depth, printf('Else feature[%d] > %.2f', feature, threshold)
            FROM model WHERE feature IS NOT NULL
            UNION ALL SELECT node_id, depth, printf('Predict: %.2f', prediction) FROM model WHERE feature IS NULL)""",
        *PRICE_TREE, model_cte(2),
    ),
    "feature_importance": query(
        """SELECT name AS feature, round(coalesce(sum(gain * n), 0.0) / (SELECT sum(gain * n) FROM model), 9)::DOUBLE
        AS importance FROM names LEFT JOIN model ON model.feature = names.i GROUP BY name""",
        *PRICE_TREE, model_cte(2),
        "names(i, name) AS (VALUES " + ", ".join(f"({i}, '{f}')" for i, f in enumerate(PRICE_FEATURES)) + ")",
    ),
    "tree_binned": query("SELECT round(avg(y), 4) AS prediction, count(*) AS n FROM l2 GROUP BY node", *PRICE_TREE),
    "tree_categorical": query(
        """SELECT round(ls / ln, 4) AS prediction, ln::BIGINT AS n FROM best
        UNION ALL SELECT round((ts - ls) / (tn - ln), 4) AS prediction, (tn - ln)::BIGINT AS n FROM best""",
        shape("prices"),
        """sums AS (SELECT 0 AS feature, avg(cents) AS place, count(*) AS n, sum(cents) AS s FROM prices GROUP BY l_linenumber
            UNION ALL SELECT 1, l_discount, count(*), sum(cents) FROM prices GROUP BY l_discount)""",
        """runs AS (SELECT feature, place, lead(place) OVER o AS nv, (sum(n) OVER o)::DOUBLE AS ln,
            (sum(s) OVER o)::DOUBLE AS ls, (sum(n) OVER p)::DOUBLE AS tn, (sum(s) OVER p)::DOUBLE AS ts FROM sums
            WINDOW o AS (PARTITION BY feature ORDER BY place), p AS (PARTITION BY feature))""",
        f"best AS (SELECT * FROM runs WHERE nv IS NOT NULL ORDER BY {GAIN} DESC LIMIT 1)",
    ),
    "depth_search_shallow": query(
        "SELECT params, round(value, 6) AS value, value = min(value) OVER () AS is_best FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{{"max_depth": {d}}}' AS params, sqrt(avg(pow(mean - y, 2))) AS value
            FROM l{d} JOIN leaf{d} USING (node) WHERE NOT fit"""
            for d in (1, 2, 3)
        )
        + ")",
        shape("trips"), FEATURED, TRIP_SOURCE, *tree_ctes("source", HOUR_FEATURES, 3),
        *[leaf_means(d, f"leaf{d}") for d in (1, 2, 3)],
    ),
    "gradient_step": query(
        terms("g", "quantity", "discount", 6, "g"),
        shape("returns"), RETURN_SOURCE, "w AS (SELECT 1e-1 AS wa, -2e-1 AS wb, 5e-2 AS wc)",
        f"""g AS (SELECT sum(({CHANCE} - y) * a) AS wa, sum(({CHANCE} - y) * b) AS wb, sum({CHANCE} - y) AS wc
        FROM source, w)""",
    ),
    "gradient_wide": """SELECT 'e[' || (64 * k + i - 1) || ']' AS term, round(sum((0.5 - y) * (e - shift)), 6) AS g FROM (
        SELECT unnest(embedding)::DOUBLE AS e, generate_subscripts(embedding, 1) AS i,
        CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS y FROM embeddings),
        (VALUES (0, 0.0::DOUBLE), (1, 0.125::DOUBLE), (2, 0.25::DOUBLE), (3, 0.5::DOUBLE)) AS copies(k, shift) GROUP BY k, i
        UNION ALL SELECT 'intercept', sum(CASE WHEN label = 0 THEN -0.5 ELSE 0.5 END)::DOUBLE FROM embeddings""",
    "lbfgs_wide": """SELECT 'e[' || i || ']' AS term, 0.0::DOUBLE AS g FROM range(64) AS r(i)
        UNION ALL SELECT 'intercept', 0.0::DOUBLE""",
    "logistic_gd": query(
        f"SELECT round(auc, 9) AS auc FROM ({area('s', 'p')})",
        shape("returns"), RETURN_SOURCE, *descent("source", 1e-5, 20), f"s AS (SELECT y, {CHANCE} AS p FROM source, w20)",
    ),
    "model_terms": query(
        terms("w20", "quantity", "discount", 9), shape("returns"), RETURN_SOURCE, *descent("source", 1e-5, 20)
    ),
    "logistic_lbfgs": query(
        terms("w12", "amount", "hour_share", 4), shape("cards"), CARD_SOURCE, *newton("source")
    ),
    "trip_job_exact": query(
        """SELECT metric, round(value, 6) AS value FROM (UNPIVOT m ON rmse, r2 INTO NAME metric VALUE value)""",
        *LOG_TRIPS,
        f"""m AS (SELECT * EXCLUDE (n) FROM (SELECT {REGRESSION} FROM (
            SELECT exp(mean) - 1 AS prediction, trip_duration AS label FROM l5 JOIN leaf USING (node) WHERE held_out)))""",
    ),
    "trip_job_predictions": query(
        "SELECT id, round(exp(mean) - 1, 4) AS trip_duration FROM l5 JOIN leaf USING (node)", *LOG_TRIPS
    ),
    "fraud_job_descent": query(
        report("scored", 9),
        shape("cards"), CARD_SOURCE, CARD_SCALED, "train AS (SELECT * FROM scaled WHERE split = 'train')",
        *descent("train", 1e-3, 20), scored("scaled", "w20"),
    ),
    "fraud_job_library": query(
        report("scored", 4), shape("cards"), CARD_SOURCE, CARD_TRAIN, *newton("train"), scored("source", "w12")
    ),
}
ORACLES["auc_rank_bucketed"] = ORACLES["auc_rank"]
ORACLES["best_split_bucketed"] = ORACLES["best_split"]
ORACLES["tree_exact_log"] = query(
    """SELECT node_id, depth::INTEGER AS depth, feature::INTEGER AS feature, threshold::DOUBLE AS threshold,
    round(gain::DOUBLE, 9) AS gain, n::BIGINT AS n, round(prediction, 9) AS prediction FROM model""",
    *LOG_DOCS,
)
ORACLES["tree_exact_cells"] = ORACLES["tree_exact_log"]
ORACLES["tree_exact_deep"] = query(MODEL_COLUMNS.replace("round(gain::DOUBLE, 2)", "round(gain::DOUBLE, 3)"), *DEEP_DOCS)
ORACLES["rare_split"] = f"""SELECT l_linenumber, {in_train('l_orderkey', 0.0004)} AS rare, count(*) AS n FROM lineitem GROUP BY ALL"""
ORACLES["auc_scores"] = ORACLES["auc_rank"].replace(
    "SELECT round(auc, 9) AS auc FROM", "SELECT round(auc, 9) AS auc, (SELECT count(*) FROM lineitem) AS n FROM"
)
ORACLES["csv_reordered"] = "SELECT event_id, event_type, value FROM events"
ORACLES["csv_repeated_header"] = "SELECT event_id, event_type FROM events"
ORACLES["cast_double"] = "SELECT o_orderkey, o_totalprice AS price, NULL::DOUBLE AS status FROM orders"
ORACLES["array_steps"] = """SELECT p_partkey, p_size::DOUBLE + p_size::DOUBLE * -0.5::DOUBLE AS m0, p_retailprice + p_retailprice * -0.5::DOUBLE AS m1,
    p_size::DOUBLE * p_size::DOUBLE + p_retailprice * p_retailprice AS length2 FROM part"""
ORACLES["tree_score_nulls"] = query(
    "SELECT round(mean, 4) AS prediction, count(*) AS n, sum(cents)::BIGINT AS cents FROM l2 JOIN leaf USING (node) WHERE NOT fit GROUP BY ALL",
    shape("prices"),
    """source AS (SELECT *, cents AS y, true AS fit FROM prices UNION ALL BY NAME
        SELECT * REPLACE (CASE WHEN cents % 3 <> 0 THEN l_quantity END AS l_quantity, CASE WHEN cents % 5 <> 0 THEN l_tax END AS l_tax),
        cents AS y, false AS fit FROM prices)""",
    *tree_ctes("source", PRICE_FEATURES, 2),
    leaf_means(2),
)


# Categories by sets, at the depth and on the features of the job; labels are whole numbers.
CATEGORICAL = ["vendor_id", "passenger_count", "store_and_fwd_flag"]
CATEGORY_TRIPS = [
    shape("trips"), FEATURED,
    f"source AS (SELECT * REPLACE (vendor_id - 1 AS vendor_id), trip_duration AS y, true AS fit FROM featured WHERE {KEPT})",
    *tree_ctes("source", TRIP_FEATURES, 10, categorical=CATEGORICAL), model_cte(10, subsets=True),
]
ORACLES["tree_exact_categorical"] = query(MODEL_COLUMNS.replace("round(gain::DOUBLE, 2)", "subset::BIGINT AS subset, floor(gain::DOUBLE * 1000 + 5e-1) / 1000").replace("threshold::DOUBLE AS", "round(threshold::DOUBLE, 9) AS"), *CATEGORY_TRIPS)
# Every depth is a part of the deepest tree.
ORACLES["depth_search_nested"] = query(
    "SELECT params, round(value, 6) AS value, value = min(value) OVER () AS is_best FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{{"max_depth": {d}}}' AS params, sqrt(avg(pow(mean - y, 2))) AS value
        FROM l{d} JOIN leaf{d} USING (node) WHERE NOT fit"""
        for d in (5, 10, 14)
    )
    + ")",
    shape("trips"), FEATURED, TRIP_SOURCE, *tree_ctes("source", TRIP_FEATURES, 14),
    *[leaf_means(d, f"leaf{d}") for d in (5, 10, 14)],
)
ORACLES["lbfgs_terms"] = ORACLES["logistic_lbfgs"]
ORACLES["csv_inferred_reordered"] = """SELECT event_id, event_type, CASE WHEN event_id % 2 = 0 THEN floor(value) ELSE value END AS value,
    CASE WHEN event_id % 2 = 1 THEN floor(value)::BIGINT END AS whole FROM events"""
# Points of the curve: groups of n // 1000 neighbouring scores, highest first.
CURVE = """scores AS (SELECT score, count_if(returned = 1) AS pos, count_if(returned = 0) AS neg FROM returns GROUP BY score),
    runs AS (SELECT score, sum(pos) OVER o AS tp, sum(neg) OVER o AS fp, row_number() OVER o - 1 AS nth,
        count(*) OVER () AS n, sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg FROM scores WINDOW o AS (ORDER BY score DESC)),
    points AS (SELECT min(score) AS threshold, max(tp) / max(all_pos) AS tpr, max(fp) / max(all_neg) AS fpr
        FROM runs GROUP BY nth // greatest(1, n // 1000))"""
ORACLES["roc_curve"] = query("SELECT threshold, round(tpr, 9) AS tpr, round(fpr, 9) AS fpr FROM points", shape("returns"), CURVE)
ORACLES["auc_binned"] = query(
    """SELECT round(sum((fpr - x) * (tpr + y) / 2) + (1 - max(fpr)) * (1 + max(tpr)) / 2, 9) AS auc FROM (
        SELECT fpr, tpr, lag(fpr, 1, 0.0::DOUBLE) OVER (ORDER BY threshold DESC) AS x, lag(tpr, 1, 0.0::DOUBLE) OVER (ORDER BY threshold DESC) AS y FROM points)""",
    shape("returns"), CURVE,
)
ORACLES["join_predictions_skewed"] = query(
    """SELECT y.o_orderkey AS id, p.o_orderkey AS row, p.prediction, y.label FROM guesses p
    JOIN guesses y ON y.o_orderkey = CASE WHEN p.o_orderkey % 3 = 0 THEN 1 ELSE p.o_orderkey END""",
    shape("guesses"),
)
ORACLES["library_rules"] = ORACLES["tree_rules"]
ORACLES["library_nodes"] = ORACLES["tree_exact"].replace("threshold::DOUBLE AS", "round(threshold::DOUBLE, 9) AS").replace("round(gain::DOUBLE, 2)", "round(gain::DOUBLE, -3)")
ORACLES["trip_job_nulls"] = query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count_if({n})::BIGINT AS null_count FROM featured"
        for c, n in [
            (c, {"passenger_count": "passenger_count = 3", "pickup_longitude": "id % 5 = 0"}.get(c, "false"))
            for c in ("id", *TRIP_FEATURES, "trip_duration")
        ]
    ),
    shape("trips"), FEATURED,
)
# The stored metrics are those of the earlier run on taxi trips.
ORACLES["trip_job_delta"] = f"""SELECT m.metric, m.value, b.value AS baseline, round(m.raw - b.value, 6) AS delta FROM (
    SELECT metric, round(value, 6) AS value, value AS raw FROM ({ORACLES["trip_job_exact"].replace("round(value, 6) AS value", "value")})) m
    JOIN (VALUES ('rmse', 389.25328786776396::DOUBLE), ('r2', 0.672272085049675::DOUBLE)) b(metric, value) USING (metric)"""

"""Queries for splits, class metrics, audits, sources and scalar functions."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from plumbline.functions import display, scalars
from plumbline.operators import assurance, classmetrics, columns, hashtree, lineage, secrets
from plumbline.operators.forest import ForestSettings, grid_search, predict
from plumbline.operators.trees import Fit, fit_forest
from plumbline.operators.split import random_split, rank_in_class, stratified_kfold, stratified_split
from plumbline.plans.learning import (
    audit_inputs,
    evaluate_model,
    holdout_run,
    load_fitted,
    record_evaluation,
    save_fitted,
    train_and_report,
)
from plumbline.plans.registry import query
from plumbline.plans.tables import document_features, table
from plumbline.session import shared_dir, stored
from plumbline.sources import datasets, manifests
from plumbline.sources.ledger import RunLedger
from plumbline.sources.logs import read_log_entries, read_logs
from plumbline.sources.synthetic import Feature, labelled_features

SEED = 42
SHARE = 0.2

# ---------------------------------------------------------------- splits


def _split_sql(source: str, key: str, target: str) -> str:
    """The held-out split in SQL: rank all rows of a class by the hash of seed and key."""
    return f"""
    WITH h AS (SELECT *, md5(concat('{SEED}', '|', CAST({key} AS VARCHAR))) AS hx FROM {source}),
    c AS (SELECT {target} AS cls, count(*) AS nc, sum(count(*)) OVER () AS n
          FROM {source} GROUP BY {target}),
    q AS (SELECT cls, CAST(ceil({SHARE} * n) AS HUGEINT) AS want, nc, n,
                 (CAST(ceil({SHARE} * n) AS HUGEINT) * nc) // n AS base,
                 (CAST(ceil({SHARE} * n) AS HUGEINT) * nc) % n AS rest FROM c),
    s AS (SELECT cls, base, row_number() OVER (ORDER BY rest DESC, cls) AS seat,
                 want - sum(base) OVER () AS spare FROM q),
    quota AS (SELECT cls, base + CASE WHEN seat <= spare THEN 1 ELSE 0 END AS take FROM s),
    r AS (SELECT h.*, row_number() OVER (PARTITION BY {target} ORDER BY hx) AS rk FROM h),
    parts AS (SELECT r.* EXCLUDE (hx, rk),
                     CASE WHEN rk <= take THEN 'test' ELSE 'train' END AS "partition"
              FROM r JOIN quota ON r.{target} = quota.cls)
    """


def _orders_split(spark, sf):
    return stratified_split(
        table(spark, sf, "orders"), "o_orderstatus", SHARE, SEED, "o_orderkey"
    )


_ORDERS = _split_sql("orders", "o_orderkey", "o_orderstatus")


@query(_ORDERS + 'SELECT o_orderkey, o_orderstatus, "partition" FROM parts', headline=True)
def stratified_split_rows(spark, sf):
    return _orders_split(spark, sf).select("o_orderkey", "o_orderstatus", "partition")


@query(
    _ORDERS
    + 'SELECT o_orderstatus, "partition", count(*) AS n_rows FROM parts GROUP BY o_orderstatus, "partition"'
)
def stratified_split_counts(spark, sf):
    return _orders_split(spark, sf).groupBy("o_orderstatus", "partition").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query(
    _split_sql("(SELECT *, 0 AS one FROM customer)", "c_custkey", "one")
    + 'SELECT c_custkey, "partition" FROM parts'
)
def random_split_rows(spark, sf):
    return random_split(table(spark, sf, "customer"), SHARE, SEED, "c_custkey").select(
        "c_custkey", "partition"
    )


@query(
    f"""SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality
        ORDER BY md5(concat('{SEED}', '|', CAST(doc_id AS VARCHAR)))) - 1) % 3 AS INTEGER) AS fold
        FROM labels"""
)
def kfold_assign(spark, sf):
    folds = stratified_kfold(table(spark, sf, "labels"), "quality", 3, SEED, "doc_id")
    return folds.select("doc_id", "quality", "fold")


@query(_ORDERS + """SELECT count(*) FILTER ("partition" = 'train') AS n_train,
    count(*) FILTER ("partition" = 'test') AS n_test, count(*) AS n_total,
    count(*) FILTER ("partition" IN ('train', 'test')) = count(*) AS complete FROM parts""")
def split_coverage(spark, sf):
    return assurance.coverage(_orders_split(spark, sf))


@query(_ORDERS + """SELECT
    (SELECT count(*) FROM (SELECT o_orderkey FROM parts WHERE "partition" = 'train'
       INTERSECT SELECT o_orderkey FROM parts WHERE "partition" = 'test')) AS shared_keys,
    (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM parts)) AS lost_keys,
    (SELECT count(*) FROM parts WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS added_keys
    """)
def split_disjoint_check(spark, sf):
    parts = _orders_split(spark, sf)
    train, test = parts.where("partition = 'train'"), parts.where("partition = 'test'")
    shared = assurance.overlap(train, test, "o_orderkey").select(F.lit("shared").alias("status"))
    gaps = assurance.coverage_gaps(table(spark, sf, "orders"), [train, test], "o_orderkey")
    count = lambda s: F.count(F.when(F.col("status") == s, 1))
    return shared.unionByName(gaps.select("status")).agg(
        count("shared").alias("shared_keys"),
        count("lost").alias("lost_keys"),
        count("added").alias("added_keys"),
    )


_PARTS = _split_sql("part", "p_partkey", "p_type")


@query(_PARTS + """SELECT p_name, p_brand, p_type FROM parts WHERE "partition" = 'train'
    INTERSECT SELECT p_name, p_brand, p_type FROM parts WHERE "partition" = 'test'""")
def shared_row_contents(spark, sf):
    parts = stratified_split(table(spark, sf, "part"), "p_type", SHARE, SEED, "p_partkey")
    slim = parts.select("p_name", "p_brand", "p_type", "partition")
    return assurance.shared_rows(
        slim.where("partition = 'train'").drop("partition"),
        slim.where("partition = 'test'").drop("partition"),
    )


@query(_PARTS + """, x AS (SELECT p_brand, p_name, p_type,
      count(*) FILTER ("partition" = 'train') AS n_train,
      count(*) FILTER ("partition" = 'test') AS n_test FROM parts GROUP BY p_brand, p_name, p_type)
    SELECT md5('{"p_brand":"' || p_brand || '","p_name":"' || p_name || '","p_type":"' || p_type || '"}')
      AS content_md5, n_train, n_test FROM x WHERE n_train > 0 AND n_test > 0""")
def leakage_audit(spark, sf):
    parts = stratified_split(table(spark, sf, "part"), "p_type", SHARE, SEED, "p_partkey")
    return assurance.leakage(parts, ["p_name", "p_brand", "p_type"])


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


@query(f"""SELECT quality, doc_id, row_number() OVER (PARTITION BY quality
    ORDER BY md5(concat('{SEED}', '|', CAST(doc_id AS VARCHAR)))) AS place FROM labels""")
def interleave_places(spark, sf):
    ranked = rank_in_class(table(spark, sf, "labels"), "quality", SEED, ["doc_id"])
    return ranked.select("quality", "doc_id", F.col("_rank").alias("place"))


# ---------------------------------------------------------------- class metrics

_RULE = """WITH p AS (SELECT l.quality AS label, CAST(d.n_chars > 300 AS INTEGER) AS prediction
    FROM labels l JOIN documents d USING (doc_id)),
    pairs AS (SELECT label, prediction, count(*) AS n FROM p GROUP BY label, prediction)"""


def _rule_predictions(spark, sf):
    return (
        table(spark, sf, "labels")
        .join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
        .select(
            F.col("quality").alias("label"), (F.col("n_chars") > 300).cast("int").alias("prediction")
        )
    )


@query("""SELECT quality AS class, count(*) AS n_rows, count(*) / (SELECT count(*) FROM labels) AS share
    FROM labels GROUP BY quality""")
def class_balance(spark, sf):
    return classmetrics.class_balance(table(spark, sf, "labels"), "quality")


@query(_RULE + " SELECT avg(CAST(label = prediction AS DOUBLE)) AS accuracy FROM p")
def accuracy_rule(spark, sf):
    return classmetrics.accuracy(_rule_predictions(spark, sf))


@query(_RULE + """, axis AS (SELECT label AS c FROM p UNION SELECT prediction FROM p)
    SELECT a.c AS label, b.c AS prediction, coalesce(n, 0) AS n
    FROM axis a CROSS JOIN axis b LEFT JOIN pairs ON pairs.label = a.c AND pairs.prediction = b.c""")
def confusion_matrix(spark, sf):
    return classmetrics.confusion_matrix(_rule_predictions(spark, sf))


@query(_RULE + """, axis AS (SELECT label AS c FROM p UNION SELECT prediction FROM p),
    t AS (SELECT c, (SELECT coalesce(sum(n), 0) FROM pairs WHERE label = c) AS support,
        (SELECT coalesce(sum(n), 0) FROM pairs WHERE prediction = c) AS predicted,
        (SELECT coalesce(sum(n), 0) FROM pairs WHERE prediction = c AND label = c) AS hits FROM axis),
    m AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / predicted END AS pr,
        CASE WHEN support = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / support END AS re FROM t),
    f AS (SELECT *, CASE WHEN pr + re = 0 THEN 0.0 ELSE 2 * pr * re / (pr + re) END AS f1 FROM m),
    z AS (SELECT CAST(sum(support) AS DOUBLE) AS total, CAST(sum(hits) AS DOUBLE) AS hits FROM f)
    SELECT CAST(c AS VARCHAR) AS class, round(pr, 9) AS "precision", round(re, 9) AS recall,
      round(f1, 9) AS f1, CAST(support AS BIGINT) AS support FROM f
    UNION ALL SELECT 'accuracy', round(hits / total, 9), round(hits / total, 9),
      round(hits / total, 9), CAST(total AS BIGINT) FROM z
    UNION ALL SELECT 'macro avg', round(avg(pr), 9), round(avg(re), 9), round(avg(f1), 9),
      CAST(sum(support) AS BIGINT) FROM f
    UNION ALL SELECT 'weighted avg', round(sum(pr * support) / sum(support), 9),
      round(sum(re * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
      CAST(sum(support) AS BIGINT) FROM f""")
def classification_report(spark, sf):
    report = classmetrics.classification_report(_rule_predictions(spark, sf))
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


# ---------------------------------------------------------------- forests

_SMALL = ForestSettings(n_trees=20, max_depth=5, seed=SEED)


def _features(spark, sf):
    return document_features(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query()
def rf_holdout_eval(spark, sf):
    settings = ForestSettings(n_trees=100, max_depth=5, seed=SEED)
    _, scored = holdout_run(
        _features(spark, sf), "quality", "doc_id", test_size=SHARE, settings=settings
    )
    return classmetrics.classification_report(scored, "quality", "prediction")


@query()
def grid_search_scores(spark, sf):
    found = grid_search(_features(spark, sf), "quality", "doc_id", _SMALL)
    rows = [(i, g["min_leaf"], g["min_split"], s) for i, g, s in found.scores]
    return spark.createDataFrame(rows, "place int, min_leaf int, min_split int, mean_accuracy double")


@query()
def internal_validation(spark, sf):
    return train_and_report(_features(spark, sf), "quality", "doc_id", _SMALL).confusion


@query("""SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS differing
    FROM labels JOIN documents USING (doc_id)""")
def model_round_trip(spark, sf):
    """A stored and reloaded model predicts every row as the fitted one does."""
    data = _features(spark, sf)
    fitted = grid_search(
        data, "quality", "doc_id", ForestSettings(5, 3, SEED, leaf_sizes=(1,), split_sizes=(2,))
    )
    path = shared_dir(spark, "model")
    datasets.save_model(fitted.model, path)
    again = datasets.load_model(spark, path)
    scored = predict(fitted, data).withColumnRenamed("prediction", "first")
    both = again.transform(scored)
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("first") != F.col("prediction").cast("int"), 1)).alias("differing"),
    )


_LABELLED = _split_sql("(SELECT doc_id, quality FROM labels JOIN documents USING (doc_id))", "doc_id", "quality")
_ONE_FIT = ForestSettings(10, 4, SEED, leaf_sizes=(1,), split_sizes=(2,))


@query(_LABELLED + """SELECT doc_id, quality, true AS known_class, true AS stored_once FROM parts WHERE "partition" = 'test'""")
def held_out_over_artifacts(spark, sf):
    """Split to two datasets, train, store and reload the model, score, write metrics and ledger."""
    root = shared_dir(spark, "run")
    parts = stratified_split(stored(_features(spark, sf), "features"), "quality", SHARE, SEED, "doc_id")
    datasets.write_dataset(parts, f"{root}/parts", partition_by=["partition"])
    read = spark.read.parquet(f"{root}/parts")
    train, test = (read.where(F.col("partition") == p).drop("partition") for p in ("train", "test"))
    audit_inputs(train, test, "doc_id")
    save_fitted(grid_search(train, "quality", "doc_id", _ONE_FIT), spark, f"{root}/model")
    scored, accuracy = evaluate_model(load_fitted(spark, f"{root}/model"), test)
    ledger = RunLedger(spark, f"{root}/ledger")
    for _ in range(2):
        record_evaluation(accuracy, f"{root}/metrics", ledger, "run-1")
    runs = ledger.read("run_metrics").agg((F.count(F.lit(1)) == 1).alias("stored_once"))
    told = F.lit(runs.first()["stored_once"])
    return scored.select("doc_id", "quality", F.col("prediction").isin(0, 1).alias("known_class"), told.alias("stored_once"))


@query("SELECT count(*) AS n_rows, true AS same_scores, true AS same_trees, true AS first_highest FROM labels JOIN documents USING (doc_id)")
def two_trainings_equal(spark, sf):
    """The same search twice, the second time over another layout of the rows."""
    rows = stored(_features(spark, sf), "features")
    settings = ForestSettings(10, 4, SEED)
    one, other = (grid_search(r, "quality", "doc_id", settings) for r in (rows, rows.repartition(5, "chars")))
    trees = [f.model.describe() for f in (one, other)]
    best = max(s for _, _, s in one.scores)
    first = next(g for _, g, s in one.scores if s == best)
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(one.scores == other.scores).alias("same_scores"),
        F.lit(trees[0] == trees[1]).alias("same_trees"),
        F.lit({**first, "score": best} == one.best_params).alias("first_highest"),
    )


_TREE_FEATURES = ("l_quantity", "l_discount", "l_tax", "l_linenumber")


def _node_sql(name: str, source: str) -> str:
    """The best split of the rows of ``source``: highest gain, then first feature, then smallest value."""
    values = " UNION ALL ".join(
        f"SELECT {i} AS f, CAST({c} AS DOUBLE) AS v, l_returnflag AS y FROM {source}" for i, c in enumerate(_TREE_FEATURES)
    )
    return f"""
    {name}_c AS (SELECT f, v, count(*) FILTER (y = 'A') AS a, count(*) FILTER (y = 'N') AS n, count(*) FILTER (y = 'R') AS r
      FROM ({values}) GROUP BY f, v),
    {name}_s AS (SELECT f, v, sum(a) OVER u AS a, sum(n) OVER u AS n, sum(r) OVER u AS r, sum(a) OVER w AS ta,
      sum(n) OVER w AS tn, sum(r) OVER w AS tr FROM {name}_c
      WINDOW w AS (PARTITION BY f), u AS (PARTITION BY f ORDER BY v)),
    {name}_g AS (SELECT f, v, ta + tn + tr AS rows_in, round(((a * a + n * n + r * r) / CAST(a + n + r AS DOUBLE)
        + ((ta - a) * (ta - a) + (tn - n) * (tn - n) + (tr - r) * (tr - r)) / CAST(ta + tn + tr - a - n - r AS DOUBLE))
        / (ta + tn + tr), 12) AS gain FROM {name}_s WHERE a + n + r < ta + tn + tr),
    {name} AS MATERIALIZED (SELECT f, v, CAST(rows_in AS DOUBLE) AS weight FROM {name}_g ORDER BY gain DESC, f, v LIMIT 1)"""


def _side_sql(source: str, node: str, sign: str) -> str:
    picked = " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(_TREE_FEATURES))
    return f"(SELECT s.* FROM {source} s, {node} b WHERE CASE b.f {picked} END {sign} b.v)"


_LOW, _HIGH = _side_sql("lineitem", "top", "<="), _side_sql("lineitem", "top", ">")
_NAMED = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_TREE_FEATURES)) + " END"
_EDGES = " UNION ALL ".join(f"SELECT DISTINCT {i} AS f, CAST({c} AS DOUBLE) AS v FROM lineitem" for i, c in enumerate(_TREE_FEATURES))


@query(f"""WITH {_node_sql("top", "lineitem")}, {_node_sql("low", _LOW)}, {_node_sql("high", _HIGH)},
    edges AS (SELECT f, v, v / 2 + lead(v) OVER (PARTITION BY f ORDER BY v) / 2 AS threshold FROM ({_EDGES})),
    nodes AS (SELECT '' AS path, * FROM top UNION ALL SELECT 'L', * FROM low UNION ALL SELECT 'R', * FROM high)
    SELECT path, {_NAMED} AS feature, round(threshold, 9) AS threshold, weight FROM nodes JOIN edges USING (f, v)
    UNION ALL SELECT 'LL', NULL, NULL, CAST(count(*) AS DOUBLE) FROM {_side_sql(_LOW, "low", "<=")}
    UNION ALL SELECT 'LR', NULL, NULL, CAST(count(*) AS DOUBLE) FROM {_side_sql(_LOW, "low", ">")}
    UNION ALL SELECT 'RL', NULL, NULL, CAST(count(*) AS DOUBLE) FROM {_side_sql(_HIGH, "high", "<=")}
    UNION ALL SELECT 'RR', NULL, NULL, CAST(count(*) AS DOUBLE) FROM {_side_sql(_HIGH, "high", ">")}""")
def tree_first_levels(spark, sf):
    """Two levels of one tree over all line items, with what each node asks."""
    fit = Fit(1, 2, 2, 1, len(_TREE_FEATURES), SEED, bootstrap=False)
    forest = fit_forest(table(spark, sf, "lineitem"), _TREE_FEATURES, "l_returnflag", ["l_orderkey", "l_linenumber"], fit)
    nodes = forest.node_table(spark)
    return nodes.select("path", "feature", F.round("threshold", 9).alias("threshold"), "weight")


@query(_LABELLED + """SELECT CAST(quality AS VARCHAR) AS class, count(*) AS support FROM parts WHERE "partition" = 'test' GROUP BY quality
    UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), count(*) FROM parts WHERE "partition" = 'test'""")
def holdout_support(spark, sf):
    """Rows of each class in the report over the held-out part."""
    _, scored = holdout_run(_features(spark, sf), "quality", "doc_id", test_size=SHARE, settings=_ONE_FIT)
    return classmetrics.classification_report(scored, "quality", "prediction").select("class", "support")


@query(
    _split_sql("(SELECT doc_id, quality, 0 AS one FROM labels JOIN documents USING (doc_id))", "doc_id", "one")
    + """SELECT doc_id, quality, true AS known_class FROM parts WHERE "partition" = 'test'"""
)
def batch_predict_rows(spark, sf):
    """The held-out rows that a batch prediction gives back, each with a class that exists."""
    return batch_predict(spark, sf).select("doc_id", "quality", F.col("prediction").isin(0, 1).alias("known_class"))


@query()
def batch_predict(spark, sf):
    parts = random_split(_features(spark, sf), SHARE, SEED, "doc_id")
    fitted = grid_search(
        parts.where("partition = 'train'").drop("partition"),
        "quality",
        "doc_id",
        ForestSettings(20, None, SEED, leaf_sizes=(2,), split_sizes=(2,)),
    )
    scored, _ = evaluate_model(fitted, parts.where("partition = 'test'").drop("partition"))
    return scored.select("doc_id", "quality", "prediction")


# ---------------------------------------------------------------- audits

_FIELDS = (
    "CAST(o_orderkey AS VARCHAR)",
    "CAST(o_custkey AS VARCHAR)",
    "o_orderstatus",
    "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)",
    "CAST(epoch_us(CAST(o_orderdate AS TIMESTAMP)) AS VARCHAR)",
    "o_orderpriority",
)
_DIGEST = "md5(" + " || ".join(f"coalesce(length({f}) || ':' || {f}, '-')" for f in _FIELDS) + ")"


@query(f"""WITH h AS (SELECT ('0x' || substr({_DIGEST}, 1, 15))::BIGINT AS h FROM orders)
    SELECT count(*) AS n_rows, CAST(sum(h) AS VARCHAR) AS hash_sum, bit_xor(h) AS hash_xor FROM h""", headline=True)
def dataset_digest(spark, sf):
    """Every column of the orders; prices as decimals and dates as times, whose text is the same everywhere."""
    orders = table(spark, sf, "orders").withColumns(
        {
            "o_totalprice": F.col("o_totalprice").cast("decimal(18,2)"),
            "o_orderdate": F.col("o_orderdate").cast("timestamp"),
        }
    )
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return assurance.dataset_digest(orders.select(*columns), portable=True)


@query("SELECT true AS same_digest, count(*) AS n_rows FROM lineitem")
def digest_ignores_layout(spark, sf):
    """The fast digest of a table and of the same table laid out differently."""
    lines = table(spark, sf, "lineitem")
    one = assurance.dataset_digest(lines)
    other = assurance.dataset_digest(lines.repartition(7, "l_partkey").sortWithinPartitions("l_tax"))
    return (
        one.unionByName(other)
        .groupBy("n_rows")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count_distinct("hash_sum", "hash_xor").alias("_d"),
        )
        .select(((F.col("_n") == 2) & (F.col("_d") == 1)).alias("same_digest"), "n_rows")
    )


def _order_rules():
    E = assurance.Expectation
    return [
        E("orders", "price is positive", F.col("o_totalprice") > 0),
        E("orders", "status is known", F.col("o_orderstatus").isin("F", "O", "P")),
        E("orders", "priority is urgent or high", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")),
        E("orders", "price below 400000", F.col("o_totalprice") < 400000),
    ]


_ORDER_RULES = [
    ("price is positive", "o_totalprice > 0"),
    ("status is known", "o_orderstatus IN ('F', 'O', 'P')"),
    ("priority is urgent or high", "o_orderpriority IN ('1-URGENT', '2-HIGH')"),
    ("price below 400000", "o_totalprice < 400000"),
]
_CHECKS_SQL = " UNION ALL ".join(
    f"""SELECT 'orders' AS section, '{name}' AS name, count(*) FILTER (NOT ({test})) = 0 AS ok,
    count(*) FILTER (NOT ({test})) AS failed_rows,
    CASE WHEN count(*) FILTER (NOT ({test})) = 0 THEN ''
         ELSE count(*) FILTER (NOT ({test})) || ' row(s) fail' END AS detail FROM orders"""
    for name, test in _ORDER_RULES
)


@query(_CHECKS_SQL, headline=True)
def expectation_suite(spark, sf):
    return assurance.run_expectations(table(spark, sf, "orders"), _order_rules())


@query(f"""SELECT count(*) FILTER (ok) AS passed, count(*) FILTER (NOT ok) AS failed,
    count(*) AS total FROM ({_CHECKS_SQL})""")
def check_summary(spark, sf):
    return assurance.check_summary(
        assurance.run_expectations(table(spark, sf, "orders"), _order_rules())
    )


@query("""SELECT doc_id, 'left_only' AS status FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT doc_id, 'right_only' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def orphans(spark, sf):
    return assurance.orphans(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query("""WITH a AS (SELECT p_brand, p_type FROM part WHERE p_size <= 25),
    b AS (SELECT p_brand, p_type FROM part WHERE p_size > 20)
    SELECT p_brand, p_type, 'left' AS side, count(*) AS times FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL
    UNION ALL SELECT p_brand, p_type, 'right', count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY ALL""")
def row_difference(spark, sf):
    part = table(spark, sf, "part")
    pick = lambda cond: part.where(cond).select("p_brand", "p_type")
    return assurance.row_difference(pick("p_size <= 25"), pick("p_size > 20"))


def _lineage(spark, sf):
    """Users as stages, whole values as artifacts; purchases write, everything else reads."""
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("stage"),
        F.floor("value").cast("string").alias("artifact"),
        F.when(F.col("event_type") == "purchase", "out").otherwise("dep").alias("direction"),
    )


_LINEAGE = """WITH lin AS (SELECT CAST(user_id AS VARCHAR) AS stage,
    CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS artifact,
    CASE WHEN event_type = 'purchase' THEN 'out' ELSE 'dep' END AS direction FROM events)"""


@query(_LINEAGE + """ SELECT artifact, count(DISTINCT stage) AS writers, min(stage) AS first_stage,
    max(stage) AS last_stage FROM lin WHERE direction = 'out' GROUP BY artifact
    HAVING count(DISTINCT stage) > 1""")
def many_writers(spark, sf):
    return assurance.many_writers(_lineage(spark, sf))


@query(_LINEAGE + """ SELECT artifact FROM lin WHERE direction = 'dep' AND stage IN ('1', '2', '3')
    INTERSECT SELECT artifact FROM lin WHERE direction = 'dep' AND stage IN ('4', '5', '6')""")
def shared_inputs(spark, sf):
    return assurance.shared_inputs(_lineage(spark, sf), ["1", "2", "3"], ["4", "5", "6"])


@query(_LINEAGE + """, a AS (SELECT artifact, bool_or(direction = 'out') AS w, bool_or(direction = 'dep') AS r
    FROM lin GROUP BY artifact)
    SELECT artifact, CASE WHEN w THEN 'unread' ELSE 'unwritten' END AS status FROM a WHERE w <> r""")
def dangling_artifacts(spark, sf):
    return assurance.dangling_artifacts(_lineage(spark, sf))


# Chains of 50 stages over the events; every tenth chain is a cycle.
_CHAIN = 50
_CHAINS_SQL = f"""e AS (SELECT event_id AS source, CASE WHEN event_id % {_CHAIN} = {_CHAIN - 1} THEN event_id - {_CHAIN - 1}
      ELSE event_id + 1 END AS target FROM events WHERE event_id % {_CHAIN} < {_CHAIN - 1} OR event_id // {_CHAIN} % 10 = 0)"""


@query(f"WITH RECURSIVE {_CHAINS_SQL}, r AS (SELECT * FROM e UNION SELECT r.source, e.target FROM r JOIN e ON r.target = e.source) SELECT * FROM r")
def lineage_reach(spark, sf):
    """Everything that each artifact feeds over any number of stages."""
    at, last = F.col("event_id") % _CHAIN, _CHAIN - 1
    ends = F.when(at == last, F.col("event_id") - last).otherwise(F.col("event_id") + 1)
    kept = table(spark, sf, "events").where((at < last) | (F.floor(F.col("event_id") / _CHAIN) % 10 == 0))
    return lineage.closure(kept.select(F.col("event_id").alias("source"), ends.alias("target")))


_EDITED_SQL = """SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 1 THEN 'removed' ELSE 'changed' END AS change
    FROM orders WHERE o_orderkey % 1000 IN (1, 2) UNION ALL SELECT -o_orderkey, 'added' FROM orders WHERE o_orderkey % 1000 = 3"""


@query(_EDITED_SQL)
def digest_tree_diff(spark, sf):
    """The orders that were edited, found by comparing two hash trees from the top."""
    orders = table(spark, sf, "orders")
    place = F.col("o_orderkey") % 1000
    edited = orders.where(place != 1).withColumn("o_totalprice", F.col("o_totalprice") + F.when(place == 2, 1).otherwise(0))
    added = orders.where(place == 3).withColumn("o_orderkey", -F.col("o_orderkey"))
    trees = [hashtree.store_tree(t, "o_orderkey", shared_dir(spark, "tree")) for t in (orders, edited.unionByName(added))]
    return hashtree.tree_diff(*trees)


_NAMES = "password|passwd|secret|token|api[_-]?key|credential"
_LITERAL = f'(?i)[A-Za-z0-9_-]*(?:{_NAMES})[A-Za-z0-9_-]*[ \\t]*=[ \\t]*"[^"]+"'
_LITERAL_2 = f'(?i)([A-Za-z0-9_-]*(?:{_NAMES})[A-Za-z0-9_-]*)[ \\t]*=[ \\t]*"([^"]+)"'


@query(f"""WITH s AS (SELECT doc_id, unnest(regexp_extract_all(text, '{_LITERAL}')) AS span FROM documents),
    v AS (SELECT doc_id, regexp_extract(span, '{_LITERAL_2}', 1) AS name,
                 trim(regexp_extract(span, '{_LITERAL_2}', 2)) AS val FROM s)
    SELECT doc_id, name, md5(val) AS value_md5 FROM v WHERE val <> '' AND NOT regexp_matches(val,
      '(?i)^(?:replace_with|changeme|<.*>|placeholder|example|dummy|xxx+|\\$\\{{)')""", headline=True)
def credential_literals(spark, sf):
    return secrets.credential_literals(table(spark, sf, "documents"), "doc_id", "text")


# Every document also appears with a secret of a kind that follows from its source, made
# from its own digest, so that each fingerprint has something to find.
_PLANT_SQL = """CASE source WHEN 'src0' THEN 'AKIA' || upper(substr(md5(text), 1, 16))
    WHEN 'src1' THEN 'ghp_' || md5(text) WHEN 'src2' THEN 'xoxb-' || substr(md5(text), 1, 12)
    WHEN 'src3' THEN '-----BEGIN RSA ' || 'PRIVATE KEY-----' ELSE substr(md5(text), 1, 12) END"""


def _planted(spark, sf):
    documents = table(spark, sf, "documents")
    digest = F.md5("text")
    secret = (
        F.when(F.col("source") == "src0", F.concat(F.lit("AKIA"), F.upper(F.substring(digest, 1, 16))))
        .when(F.col("source") == "src1", F.concat(F.lit("ghp_"), digest))
        .when(F.col("source") == "src2", F.concat(F.lit("xoxb-"), F.substring(digest, 1, 12)))
        .when(F.col("source") == "src3", F.concat(F.lit("-----BEGIN RSA "), F.lit("PRIVATE KEY-----")))
        .otherwise(F.substring(digest, 1, 12))
    )
    plain = documents.select(F.col("doc_id").cast("string").alias("item"), "text")
    marked = documents.select(
        F.concat(F.col("doc_id").cast("string"), F.lit("+")).alias("item"),
        F.concat("text", F.lit(" "), secret).alias("text"),
    )
    return plain.unionByName(marked)


_PLANTED_SQL = f"""WITH x AS (SELECT CAST(doc_id AS VARCHAR) AS item, text FROM documents
    UNION ALL SELECT CAST(doc_id AS VARCHAR) || '+', text || ' ' || {_PLANT_SQL} FROM documents),
    k(kind, pattern) AS (VALUES ('AWS access key id', 'AKIA[0-9A-Z]{{16}}'),
      ('GitHub token', 'gh[pousr]_[A-Za-z0-9]{{20,}}'), ('Slack token', 'xox[baprs]-[A-Za-z0-9-]{{10,}}'),
      ('private key block', '-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----'))"""


@query(_PLANTED_SQL + " SELECT item, kind FROM x JOIN k ON regexp_matches(text, pattern)", headline=True)
def secret_fingerprints(spark, sf):
    return secrets.secret_fingerprints(_planted(spark, sf), "item", "text")


@query(_PLANTED_SQL + """ SELECT item, kind, CAST(len(regexp_extract_all(text, pattern)) AS INTEGER) AS hits
    FROM x JOIN k ON regexp_matches(text, pattern)""")
def fingerprint_hits(spark, sf):
    return secrets.fingerprint_spans(_planted(spark, sf), "item", "text")


@query("""SELECT event_id, 'a.b[0].c.d.k' AS path, json_extract_string(props, '$.k') AS value, 'ok' AS status FROM events
    WHERE event_id % 7 <> 3 UNION ALL SELECT event_id, NULL, '{' || props, 'malformed' FROM events WHERE event_id % 7 = 3""")
def json_props_walk(spark, sf):
    """Event properties five levels down in a larger document; some documents are broken."""
    deep = F.concat(F.lit('{"a":{"b":[{"c":{"d":'), F.col("props"), F.lit('}}],"e":[]}}'))
    broken = F.concat(F.lit("{"), F.col("props"))
    events = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 7 == 3, broken).otherwise(deep).alias("document")
    )
    return secrets.walk_strings(events, "event_id", "document")


@query("""SELECT event_id, 'api_token' AS name, md5('v' || json_extract_string(props, '$.k')) AS value_md5
    FROM events WHERE event_type IN ('click', 'view')""")
def credential_entries(spark, sf):
    """Documents built from the events: a real token for some types, a placeholder for others."""
    value = F.concat(
        F.when(F.col("event_type").isin("click", "view"), "v").otherwise("changeme"),
        scalars.config_value("props", "k"),
    )
    names = F.when(F.col("event_type") == "purchase", "note").otherwise("api_token")
    entries = table(spark, sf, "events").select("event_id", names.alias("name"), value.alias("value"))
    return secrets.credential_entries(entries).select(
        "event_id", "name", F.md5("value").alias("value_md5")
    )


# ---------------------------------------------------------------- sources and sinks

_ORDER_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)


@query("SELECT * FROM orders")
def csv_round_trip(spark, sf):
    path = shared_dir(spark, "csv")
    datasets.write_dataset(table(spark, sf, "orders"), path, "csv")
    return datasets.read_dataset(spark, path, _ORDER_SCHEMA, required=["o_orderkey"])


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def parquet_round_trip(spark, sf):
    path = shared_dir(spark, "parquet")
    datasets.write_dataset(table(spark, sf, "customer"), path, partition_by=["c_mktsegment"])
    return spark.read.parquet(path).select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )


@query("""SELECT count(*) FILTER (o_orderstatus <> 'P') AS good_rows,
    count(*) FILTER (o_orderstatus = 'P') AS malformed_lines FROM orders""")
def malformed_rows(spark, sf):
    """Orders as CSV, where every line of one status has a field too many."""
    path = shared_dir(spark, "lines")
    orders = table(spark, sf, "orders").select(
        F.concat_ws(
            ",",
            F.col("o_orderkey"),
            F.when(F.col("o_orderstatus") == "P", F.lit("P,surplus")).otherwise(F.col("o_orderstatus")),
        ).alias("o_orderkey,o_orderstatus")
    )
    # With another separator the commas are plain text, so nothing is quoted.
    orders.write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)
    marked = datasets.read_dataset(
        spark, path, "o_orderkey bigint, o_orderstatus string", malformed="keep"
    )
    good, bad = datasets.split_malformed(marked)
    tag = lambda df, g: df.select("o_orderkey", F.lit(g).alias("good"))
    return tag(good, True).unionByName(tag(bad, False)).agg(
        F.count(F.when(F.col("good"), F.col("o_orderkey"))).alias("good_rows"),
        F.count(F.when(~F.col("good"), F.col("o_orderkey"))).alias("malformed_lines"),
    )


@query("SELECT count(*) AS n_rows, count(DISTINCT quality) AS n_classes FROM labels")
def metrics_json(spark, sf):
    path = shared_dir(spark, "metrics")
    metrics = table(spark, sf, "labels").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("quality").alias("n_classes")
    )
    datasets.write_metrics_json(metrics, path)
    return spark.read.schema("n_classes bigint, n_rows bigint").json(path)


@query("SELECT count(*) AS n_rows FROM part")
def passthrough_rows(spark, sf):
    """Rows counted while they are written, then compared with what was written."""
    path = shared_dir(spark, "through")
    out, seen = columns.passthrough(table(spark, sf, "part"))
    datasets.write_dataset(out, path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).where(
        F.col("n_rows") == F.lit(seen.get["rows"])
    )


@query("""SELECT url || '#' || page_id AS path, CAST(octet_length(encode(html)) AS BIGINT) AS length,
    md5(html) AS md5, sha256(html) AS sha256 FROM pages""", headline=True)
def content_manifest(spark, sf):
    return manifests.content_manifest(_pages(spark, sf), "path", "html")


def _pages(spark, sf):
    path = F.concat("url", F.lit("#"), F.col("page_id").cast("string"))
    return table(spark, sf, "pages").select(path.alias("path"), "html", "url")


@query("""WITH p AS (SELECT url || '#' || page_id AS path, url, sha256(html) AS sha FROM pages),
    e AS (SELECT path, CASE WHEN url LIKE 'https:%' THEN ' ' || upper(sha) || ' ' ELSE md5(sha) END AS pin
          FROM p WHERE url NOT LIKE '%/fr/%')
    SELECT p.path, CASE WHEN e.path IS NULL THEN 'unpinned' WHEN lower(trim(pin)) = sha THEN 'ok'
      ELSE 'mismatch' END AS status FROM p LEFT JOIN e USING (path)
    UNION ALL SELECT 'gone/' || path, 'missing' FROM e WHERE pin LIKE ' %'""")
def manifest_verify(spark, sf):
    """Pins derived from the pages: some padded and upper-case, some wrong, some absent."""
    pages = _pages(spark, sf)
    actual = manifests.content_manifest(pages, "path", "html")
    sha = F.sha2("html", 256)
    secure = F.col("url").startswith("https:")
    pins = pages.where(~F.col("url").contains("/fr/")).select(
        "path",
        F.when(secure, F.concat(F.lit(" "), F.upper(sha), F.lit(" "))).otherwise(F.md5(sha)).alias("sha256"),
        secure.alias("_s"),
    )
    gone = pins.where("_s").withColumn("path", F.concat(F.lit("gone/"), F.col("path")))
    expected = pins.unionByName(gone).drop("_s")
    return manifests.verify_manifest(actual, expected).select("path", "status")


@query("""WITH p AS (SELECT url || '#' || page_id AS path, url FROM pages)
    SELECT path, CASE WHEN url LIKE '%/fr/%' THEN 'removed' WHEN url LIKE '%/de/%' THEN 'changed'
      ELSE 'same' END AS change FROM p
    UNION ALL SELECT 'new/' || path, 'added' FROM p WHERE url LIKE '%/es/%'""")
def snapshot_diff(spark, sf):
    pages = _pages(spark, sf)
    old = manifests.content_manifest(pages, "path", "html")
    kept = pages.where(~F.col("url").contains("/fr/")).withColumn(
        "html",
        F.when(F.col("url").contains("/de/"), F.concat("html", F.lit("x"))).otherwise(F.col("html")),
    )
    fresh = pages.where(F.col("url").contains("/es/")).withColumn(
        "path", F.concat(F.lit("new/"), F.col("path"))
    )
    new = manifests.content_manifest(kept.unionByName(fresh), "path", "html")
    return manifests.snapshot_diff(old, new)


@query()
def file_manifest(spark, sf):
    return manifests.file_manifest(spark, sf, "*.parquet")


@query()
def large_file_manifest(spark, sf):
    return manifests.large_file_manifest(spark, sf, "*.parquet")


@query("""SELECT page_id, octet_length(encode(coalesce(html, ''))) AS length, md5(coalesce(html, '')) AS md5, sha256(coalesce(html, '')) AS sha256 FROM pages
    UNION ALL SELECT -1 - page_id, 0, md5(''), sha256('') FROM pages WHERE page_id % 50 = 0""")
def page_file_digests(spark, sf):
    """Every page as a file of its own, and some empty ones, digested where they lie."""
    pages = table(spark, sf, "pages").select("page_id", "html")
    empty = pages.where(F.col("page_id") % 50 == 0).select((-1 - F.col("page_id")).alias("page_id"), F.lit(None).cast("string").alias("html"))
    folder = F.pmod("page_id", F.lit(16)).cast("string")
    named = pages.union(empty).withColumn("file", F.concat_ws("/", folder, F.concat(F.col("page_id").cast("string"), F.lit(".html"))))
    root = shared_dir(spark, "pages")
    manifests.write_files(named, root, "file", "html")
    found = manifests.large_file_manifest(spark, root, "*.html")
    number = F.regexp_extract("path", r"/(-?[0-9]+)\.html$", 1).cast("bigint")
    return found.select(number.alias("page_id"), "length", "md5", "sha256")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def landed_rows(spark, sf):
    """Orders exported one folder per status; the files of one status have a wrong pin."""
    source, dest = shared_dir(spark, "incoming"), shared_dir(spark, "landed")
    slim = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderstatus").alias("status")
    )
    slim.write.partitionBy("status").option("header", True).csv(source)
    files = manifests.file_manifest(spark, source)
    wrong = F.when(F.col("path").contains("status=P"), F.md5("sha256")).otherwise(F.upper("sha256"))
    manifests.land_dataset(
        spark,
        source,
        dest,
        files.select("path", wrong.alias("sha256")),
        schema="o_orderkey bigint, o_orderstatus string",
    )
    return spark.read.parquet(dest).select("o_orderkey", "o_orderstatus")


_RUNS_SQL = """WITH r AS (SELECT 'run-' || user_id AS run_id, event_type AS name, round(sum(CAST(value AS
    DECIMAL(18,2))), 2)::DOUBLE AS value FROM events GROUP BY user_id, event_type)"""


@query(_RUNS_SQL + """ SELECT run_id, 'shop' AS experiment, stage, name, value
    FROM r, (VALUES ('evaluate'), ('train')) AS s(stage)""")
def run_ledger(spark, sf):
    """Metrics of two stages of many runs, each appended twice; the second time adds nothing."""
    ledger = RunLedger(spark, shared_dir(spark, "ledger"))
    rows = (
        table(spark, sf, "events")
        .groupBy(F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"), "event_type")
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"))
        .select("run_id", F.lit("shop").alias("experiment"), F.col("event_type").alias("name"), "value")
    )
    for stage in ("train", "train", "evaluate", "evaluate"):
        ledger.append("run_metrics", rows.withColumn("stage", F.lit(stage)))
    return ledger.read("run_metrics").select("run_id", "experiment", "stage", "name", "value")


@query(_RUNS_SQL + """ SELECT run_id, 'shop' AS experiment, 'train' AS stage, name, value FROM r""")
def concurrent_appends(spark, sf):
    """Eight writers append overlapping runs at the same time; every run is stored once."""
    ledger = RunLedger(spark, shared_dir(spark, "ledger"))
    runs = stored(
        table(spark, sf, "events")
        .groupBy(F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"), F.col("event_type").alias("name"))
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"))
        .select("run_id", F.lit("shop").alias("experiment"), F.lit("train").alias("stage"), "name", "value"),
        "runs",
    )
    part = F.pmod(F.xxhash64("run_id"), F.lit(8))
    writes = [runs.where(part.isin(i, (i + 1) % 8)) for i in range(8)]
    with ThreadPool(8) as pool:
        pool.map(inheritable_thread_target(spark)(lambda rows: ledger.append("run_metrics", rows)), writes, chunksize=1)
    return ledger.read("run_metrics")


_LOGS_SQL = """WITH e AS (SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS at_text,
    CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, event_type AS stage,
    'event ' || event_id AS message, event_type = 'error' AS bad FROM events)"""


def _write_logs(spark, sf) -> str:
    """Events as log lines; an error is followed by two traceback lines."""
    error = F.col("event_type") == "error"
    line = F.concat_ws(
        " | ",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.rpad(F.when(error, "ERROR").otherwise("INFO"), 8, " "),
        F.col("event_type"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")),
    )
    trace = F.concat(line, F.lit("\nTraceback (most recent call last):\n  in "), F.col("event_id").cast("string"))
    path = shared_dir(spark, "logs")
    table(spark, sf, "events").select(
        F.when(error, trace).otherwise(line).alias("value")
    ).write.text(path)
    return path


@query(_LOGS_SQL + """ SELECT level, stage, message, false AS continuation FROM e
    UNION ALL SELECT NULL, NULL, 'Traceback (most recent call last):', true FROM e WHERE bad
    UNION ALL SELECT NULL, NULL, '  in ' || substr(message, 7), true FROM e WHERE bad""")
def log_lines(spark, sf):
    return read_logs(spark, _write_logs(spark, sf)).select("level", "stage", "message", "continuation")


@query(_LOGS_SQL + """ SELECT CAST(at_text AS TIMESTAMP) AS ts, level, stage, message, false AS continuation FROM e
    UNION ALL SELECT CAST(at_text AS TIMESTAMP), level, stage, 'Traceback (most recent call last):', true FROM e WHERE bad
    UNION ALL SELECT CAST(at_text AS TIMESTAMP), level, stage, '  in ' || substr(message, 7), true FROM e WHERE bad""")
def log_entries(spark, sf):
    return read_log_entries(spark, _write_logs(spark, sf))


_FEATURES = [
    Feature("glucose", 110.0, 20.0, shift=30.0),
    Feature("bmi", 30.0, 5.0, shift=4.0, digits=1, lowest=10.0),
    Feature("age", 35.0, 12.0, uniform=True),
]


def _u_sql(feature: str, tail: str = "") -> str:
    text = f"concat_ws('|', '{SEED}', CAST(doc_id AS VARCHAR), '{feature}'{tail})"
    return f"((('0x' || substr(md5({text}), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)"


def _n_sql(feature: str) -> str:
    r, a = _u_sql(feature, ", 'r'"), _u_sql(feature, ", 'a'")
    return f"(sqrt(-2.0 * ln({r})) * cos(2.0 * pi() * {a}))"


@query(f"""SELECT doc_id, CAST(round_even(110.0 + 30.0 * quality + 20.0 * {_n_sql('glucose')}, 0) AS BIGINT) AS glucose,
    CAST(round_even(greatest(30.0 + 4.0 * quality + 5.0 * {_n_sql('bmi')}, 10.0), 1) AS DOUBLE) AS bmi,
    CAST(round_even(35.0 + 12.0 * (2.0 * {_u_sql('age')} - 1.0), 0) AS BIGINT) AS age, quality FROM labels""")
def synthetic_features(spark, sf):
    return labelled_features(table(spark, sf, "labels"), "doc_id", "quality", _FEATURES, SEED)


# ---------------------------------------------------------------- scalar functions


@query("""WITH u AS (SELECT page_id, url FROM pages UNION ALL
      SELECT page_id, regexp_replace(url, '^https?://', 'S3://') FROM pages UNION ALL
      SELECT page_id, regexp_replace(url, '^https?://[^/]*', 's3://') FROM pages),
    c AS (SELECT page_id, url, regexp_replace(url, '[?#].*$', '') AS plain FROM u)
    SELECT page_id, url AS uri, nullif(regexp_extract(plain, '^(?i:s3)://([^/]+)/+([^/].*)$', 1), '') AS bucket,
      nullif(regexp_extract(plain, '^(?i:s3)://([^/]+)/+([^/].*)$', 2), '') AS key FROM c""")
def uri_parts(spark, sf):
    pages = table(spark, sf, "pages")
    forms = F.array(
        F.col("url"),
        F.regexp_replace("url", "^https?://", "S3://"),
        F.regexp_replace("url", "^https?://[^/]*", "s3://"),
    )
    found = scalars.uri_parts("uri")
    return pages.select("page_id", F.explode(forms).alias("uri")).select(
        "page_id", "uri", found["bucket"].alias("bucket"), found["key"].alias("key")
    )


@query("""WITH u AS (SELECT page_id, url FROM pages UNION ALL SELECT page_id, 'FILE:' || url FROM pages
      UNION ALL SELECT page_id, './' || regexp_replace(url, '^https?://', '') FROM pages)
    SELECT page_id, url AS uri, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) IN ('', 'file')
      AS is_local FROM u""")
def local_uris(spark, sf):
    forms = F.array(
        F.col("url"),
        F.concat(F.lit("FILE:"), F.col("url")),
        F.concat(F.lit("./"), F.regexp_replace("url", "^https?://", "")),
    )
    return table(spark, sf, "pages").select("page_id", F.explode(forms).alias("uri")).withColumn(
        "is_local", scalars.is_local_uri("uri")
    )


@query("""WITH t AS (SELECT event_id, CASE event_type WHEN 'click' THEN ' Yes ' WHEN 'view' THEN 'on'
      WHEN 'error' THEN '  ' WHEN 'signup' THEN NULL ELSE 'no' END AS raw FROM events)
    SELECT event_id, coalesce(lower(trim(raw)) IN ('1', 'true', 'yes', 'on'), false) AS flag,
      coalesce(nullif(trim(raw), ''), 'unset') AS filled FROM t""")
def flags_and_defaults(spark, sf):
    raw = (
        F.when(F.col("event_type") == "click", " Yes ")
        .when(F.col("event_type") == "view", "on")
        .when(F.col("event_type") == "error", "  ")
        .when(F.col("event_type") == "signup", None)
        .otherwise("no")
    )
    return table(spark, sf, "events").withColumn("raw", raw).select(
        "event_id", scalars.truthy("raw").alias("flag"), scalars.blank_to("raw", "unset").alias("filled")
    )


@query("""SELECT event_id, printf('%.0f', round_even(value, 0)) || '%' AS percent_text,
    user_id || '/' || event_type || ' at ' || printf('%.0f', round_even(value, 0)) AS message,
    value * 1000 AS millis, json_extract_string(props, '$.k') AS k, true AS has_k, false AS has_j FROM events""")
def rendered_values(spark, sf):
    labels = F.create_map(
        F.lit("user"), F.col("user_id").cast("string"), F.lit("kind"), F.col("event_type")
    )
    return table(spark, sf, "events").select(
        "event_id",
        F.concat(scalars.percent_text("value"), F.lit("%")).alias("percent_text"),
        scalars.template("{user}/{kind} at {value}", labels, F.col("value")).alias("message"),
        scalars.epoch_millis("value").alias("millis"),
        scalars.config_value("props", "k").alias("k"),
        scalars.config_has("props", "k").alias("has_k"),
        scalars.config_has("props", "j").alias("has_j"),
    )


@query("""SELECT p_partkey, CASE WHEN p_retailprice >= 1050 THEN 'high' WHEN p_retailprice >= 950 THEN 'middle'
    ELSE 'low' END AS price_band, CASE WHEN p_size = 1 THEN 'Up' WHEN p_size = 0 THEN 'DOWN' END AS size_text
    FROM part""")
def threshold_bands(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        display.band("p_retailprice", [(None, "low"), (950, "middle"), (1050, "high")]).alias("price_band"),
        display.map_value("p_size", display.UP_DOWN).alias("size_text"),
    )


@query("""SELECT event_type AS stage, count(*) FILTER (event_type IN ('click', 'view', 'purchase')) AS accepted,
    count(*) FILTER (event_type NOT IN ('click', 'view', 'purchase')) AS refused FROM events GROUP BY event_type""")
def allowed_stages(spark, sf):
    rows = table(spark, sf, "events").select(F.col("event_type").alias("stage"))
    ok, refused = columns.allow_values(rows, "stage", ["click", "view", "purchase"])
    both = ok.withColumn("ok", F.lit(True)).unionByName(refused.withColumn("ok", F.lit(False)))
    return both.groupBy("stage").agg(
        F.count(F.when(F.col("ok"), 1)).alias("accepted"), F.count(F.when(~F.col("ok"), 1)).alias("refused")
    )

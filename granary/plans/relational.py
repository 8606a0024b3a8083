"""Queries of joins, aggregates, windows, orders, sets and evaluations, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.functions import text as X
from granary.operators import balance, evaluation, runs, sampling
from granary.plans.base import query, table

C = F.col


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


# ---------------------------------------------------------------- joins

@query("SELECT c.conv_id, c.turn, d.doc_id, d.source FROM conversations c LEFT JOIN documents d ON d.doc_id = c.conv_id * 7")
def join_01_candidate_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sampling.keep_last(_docs(spark, sf_dir).select("doc_id", "source"), ["doc_id"], ["source"])
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", (C("conv_id") * 7).alias("doc_id_")).join(docs, C("doc_id_") == C("doc_id"), "left").select("conv_id", "turn", "doc_id", "source")


@query("SELECT doc_id, 'prompt-' || doc_id AS prompt_id FROM documents WHERE NOT (doc_id % 3 = 0 OR doc_id % 5 = 0)")
def join_03_resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third and a fifth of the prompts are done; some rows of another hash or model don't count."""
    h = F.sha2(C("text"), 256)
    plan = _docs(spark, sf_dir).select("doc_id", F.concat(F.lit("prompt-"), C("doc_id").cast("string")).alias("prompt_id"), h.alias("prompt_hash"))
    accepted = plan.filter("doc_id % 3 = 0 or doc_id % 7 = 0").withColumn("model", F.when(C("doc_id") % 3 == 0, "m").otherwise("other"))
    rejected = plan.filter("doc_id % 5 = 0 or doc_id % 11 = 0").withColumns({"model": F.lit("m"), "prompt_hash": F.when(C("doc_id") % 5 == 0, C("prompt_hash")).otherwise("stale")})
    return runs.left_to_do(plan, accepted, rejected, "m").select("doc_id", "prompt_id")


@query("SELECT p.item_id, d.doc_id, d.lang FROM benchmark p JOIN documents d ON d.doc_id = p.item_id")
def join_02_prompt_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id").join(_docs(spark, sf_dir).select("doc_id", "lang"), C("item_id") == C("doc_id"))


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 ELSE 1 END AS most FROM documents")
def join_05_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = spark.createDataFrame([("en", 4), ("de", 2)], "lang string, bound int")
    return _docs(spark, sf_dir).select("doc_id", "lang").join(F.broadcast(profiles), "lang", "left").select("doc_id", F.coalesce("bound", F.lit(1)).alias("most"))


@query("SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def join_10_anti_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("SELECT r.r_name, n.n_name, count(DISTINCT c.c_custkey) AS customers, count(o.o_orderkey) AS orders FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey JOIN customer c ON c.c_nationkey = n.n_nationkey LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY ALL")
def join_11_multi_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects over two small relations to a large one, as technique lookups go; orders are counted before they join."""
    t = lambda n: table(spark, sf_dir, n)
    orders = t("orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    places = t("nation").join(t("region"), C("n_regionkey") == C("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    each = t("customer").select("c_custkey", "c_nationkey").join(orders, C("c_custkey") == C("o_custkey"), "left")
    per = each.groupBy("c_nationkey").agg(F.count("c_custkey").alias("customers"), F.coalesce(F.sum("n"), F.lit(0)).alias("orders"))
    return per.join(places, C("c_nationkey") == C("n_nationkey")).select("r_name", "n_name", "customers", "orders")


# ---------------------------------------------------------------- evaluation

_SCORES = """
WITH raw AS (SELECT d.doc_id AS case_id, d.lang AS task_type, 5.0::DOUBLE AS max_points, (CASE WHEN quality = 1 THEN 4.0 ELSE 6.0 END - toxic * 7.0)::DOUBLE AS base_raw, (CASE WHEN d.lang = 'de' THEN 3.5 ELSE 4.5 END - toxic)::DOUBLE AS tuned_raw FROM labels l JOIN documents d USING (doc_id)),
base AS (SELECT *, round(greatest(0.0, least(base_raw, max_points)), 4) AS score, round(greatest(0.0, least(base_raw, max_points)) / max_points, 4) AS s FROM raw),
tuned AS (SELECT *, round(greatest(0.0, least(tuned_raw, max_points)) / max_points, 4) AS s FROM raw),
cb AS (SELECT coalesce(task_type, '(all)') AS task_type, count(*) AS cases, round(avg(s), 4) AS m FROM base GROUP BY ROLLUP (task_type)),
ct AS (SELECT coalesce(task_type, '(all)') AS task_type, count(*) AS cases, round(avg(s), 4) AS m FROM tuned GROUP BY ROLLUP (task_type)),
cmp AS (SELECT task_type, cb.m AS baseline, ct.m AS tuned, round(ct.m - cb.m, 4) AS delta, task_type <> '(all)' AND ct.m - cb.m < -0.05 AS regressed, true AS compatible FROM cb JOIN ct USING (task_type))
"""


def _raw_scores(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    labels, docs = table(spark, sf_dir, "labels"), _docs(spark, sf_dir).select("doc_id", "lang")
    base = F.when(C("quality") == 1, 4.0).otherwise(6.0) - C("toxic") * 7.0
    tuned = F.when(C("lang") == "de", 3.5).otherwise(4.5) - C("toxic")
    return labels.join(docs, "doc_id").select(C("doc_id").alias("case_id"), C("lang").alias("task_type"), F.lit(5.0).alias("max_points"), (base if which == "base" else tuned).alias("score"))


@query(_SCORES + "SELECT case_id, task_type, max_points, score, s AS normalized_score FROM base")
def agg_11_case_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.case_scores(_raw_scores(spark, sf_dir, "base"))


@query(_SCORES + "SELECT task_type, cases, m AS mean_score FROM cb")
def agg_10_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.scorecard(evaluation.case_scores(_raw_scores(spark, sf_dir, "base"))).withColumn("task_type", F.coalesce("task_type", F.lit("(all)")))


def _comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = lambda w: evaluation.scorecard(evaluation.case_scores(_raw_scores(spark, sf_dir, w)))
    return evaluation.compared(card("base"), card("tuned"))


@query(_SCORES + "SELECT * FROM cmp")
def join_07_scorecard_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparison(spark, sf_dir)


@query(_SCORES + "SELECT round(max(CASE WHEN task_type = '(all)' THEN tuned - baseline END), 4) AS overall_delta, coalesce(string_agg(CASE WHEN regressed THEN task_type END, ',' ORDER BY task_type), '') AS severe, max(CASE WHEN task_type = '(all)' THEN tuned - baseline END) > 0 AND NOT bool_or(regressed) AS passes FROM cmp")
def agg_17_regression_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.gate(_comparison(spark, sf_dir))


@query("WITH each AS (SELECT item_id, sha256(item_id || ':' || text) AS d FROM benchmark) SELECT count(*) AS cases, sha256(string_agg(d, ',' ORDER BY item_id)) AS fingerprint FROM each")
def agg_14_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.fingerprint(table(spark, sf_dir, "benchmark"), "item_id", F.concat(C("item_id").cast("string"), F.lit(":"), "text"))


@query("SELECT 'case-' || item_id % 30 AS case_id, count(*) AS n FROM benchmark GROUP BY ALL HAVING count(*) > 1")
def val_15_case_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases numbered so that some numbers come twice."""
    return evaluation.duplicates(table(spark, sf_dir, "benchmark").select(F.concat(F.lit("case-"), (C("item_id") % 30).cast("string")).alias("case_id")), "case_id")


@query("SELECT doc_id, CASE WHEN toxic = 1 THEN NULL ELSE quality * 6.0 END AS verdict_score, CASE WHEN toxic = 1 THEN 'no score' WHEN quality = 1 THEN 'score out of range' WHEN doc_id % 2 = 0 THEN 'no reason' END AS problem FROM labels")
def val_16_judge_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.when(C("toxic") == 1, "none").otherwise(F.to_json(F.struct((C("quality") * 6.0).alias("score"), F.when(C("doc_id") % 2 == 1, "seen").alias("reason"))))
    return evaluation.judged(table(spark, sf_dir, "labels").select("doc_id", F.lit(5.0).alias("max_points"), answer.alias("answer"))).select("doc_id", "verdict_score", "problem")


@query("SELECT event_type AS run, event_id, count(*) OVER w AS cases_so_far, round(avg(v) OVER w, 4) AS mean_so_far FROM (SELECT event_type, event_id, CASE WHEN user_id % 2 = 0 THEN 1.0 ELSE 0.25 END::DOUBLE AS v FROM events) WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)")
def win_08_running_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(C("event_type").alias("run"), "event_id", F.when(C("user_id") % 2 == 0, 1.0).otherwise(0.25).alias("normalized_score"))
    return evaluation.running(e, order="event_id").select("run", "event_id", "cases_so_far", "mean_so_far")


# ---------------------------------------------------------------- aggregates

@query("SELECT c_mktsegment AS vendor, count(*) AS entries, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses, min(o_orderdate)::DATE AS first_day FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL HAVING count(*) >= 2")
def agg_09_vendor_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), C("o_custkey") == C("c_custkey"))
    g = rows.groupBy(C("c_mktsegment").alias("vendor"))
    return g.agg(F.count("*").alias("entries"), F.count_if(C("o_orderpriority") == "1-URGENT").alias("urgent"), F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statuses"), F.min("o_orderdate").cast("date").alias("first_day")).filter("entries >= 2")


@query("SELECT p_brand, p_type, arg_max(p_partkey, (p_size, p_retailprice, p_partkey)) AS best FROM part GROUP BY ALL")
def agg_16_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.max_by("p_partkey", F.struct("p_size", "p_retailprice", "p_partkey")).alias("best"))


@query("SELECT lang, sum(CASE WHEN len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) < 250 THEN 1 ELSE 3 END)::BIGINT AS pairs FROM documents GROUP BY ALL")
def agg_07_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).groupBy("lang").agg(F.sum(F.when(X.word_count(C("text")) < 250, 1).otherwise(3)).alias("pairs"))


_TWICE = "WITH corpus AS (SELECT doc_id, source, 0 AS line FROM documents UNION ALL SELECT doc_id, 'copy', 1 FROM documents WHERE doc_id % 10 = 0)"


def _twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    return d.select("doc_id", "source", F.lit(0).alias("line")).union(d.filter("doc_id % 10 = 0").select("doc_id", F.lit("copy"), F.lit(1)))


@query(_TWICE + " SELECT source, count(*) AS docs, count(DISTINCT doc_id) AS distinct_docs FROM corpus GROUP BY ALL")
def agg_08_corpus_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.corpus_counts(_twice(spark, sf_dir))


@query(_TWICE + " SELECT doc_id, source, line, 0 AS first_line FROM corpus WHERE line = 1")
def val_12_corpus_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.duplicates(_twice(spark, sf_dir), "doc_id", ["line"])


@query("SELECT prompt_id, 2 AS requested, pairs, problems, pairs = 2 AND problems = 0 AS accepted FROM (SELECT conv_id AS prompt_id, count(*) AS pairs, sum(CASE WHEN role = 'system' THEN 1 ELSE 0 END)::BIGINT AS problems FROM conversations GROUP BY ALL)")
def val_11_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = F.when(C("role") == "system", F.array(F.lit("a system turn"))).otherwise(F.array().cast("array<string>"))
    return runs.acceptance(table(spark, sf_dir, "conversations").select(C("conv_id").alias("prompt_id"), F.lit(2).alias("requested"), issues.alias("issues")))


# ---------------------------------------------------------------- windows and orders

@query(_TWICE + " SELECT doc_id, arg_min(source, line) AS source FROM corpus GROUP BY doc_id")
def win_01_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.keep_first(_twice(spark, sf_dir), ["doc_id"], ["line"]).select("doc_id", "source")


@query(_TWICE + " SELECT doc_id, arg_max(source, line) AS source FROM corpus GROUP BY doc_id")
def win_02_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.keep_last(_twice(spark, sf_dir), ["doc_id"], ["line"]).select("doc_id", "source")


@query("""
WITH d AS (SELECT doc_id, source, lang, len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) AS w, 3 + substr(source, 4)::INT AS target FROM documents WHERE source <> 'src0'),
b AS (SELECT *, CASE WHEN w < 250 THEN 0 WHEN w < 750 THEN 1 WHEN w < 2000 THEN 2 ELSE 3 END AS bucket FROM d),
t AS (SELECT *, row_number() OVER (PARTITION BY source, bucket, lang ORDER BY doc_id) AS turn FROM b),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY turn, bucket, lang) AS place FROM t)
SELECT source, place::INT AS place, doc_id FROM p WHERE place <= target""")
def win_03_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id", "source", C("lang").alias("content_type"), X.word_count(C("text")).alias("word_count"))
    targets = spark.createDataFrame([(f"src{k}", 3 + k) for k in range(1, 20)], "source string, target int")
    return sampling.round_robin(docs, targets).select("source", "place", "doc_id")


@query("WITH c AS (SELECT row_number() OVER w AS n, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w AS bad FROM events WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)), h AS (SELECT * FROM c WHERE n >= 20 AND bad / n::DOUBLE >= 0.2) SELECT min(n) AS tripped_at, arg_min(bad, n)::BIGINT AS rejected FROM h")
def win_06_circuit_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.tripped(table(spark, sf_dir, "events"), ["ts", "event_id"], C("event_type") == "error")


@query("SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) AS nth FROM documents")
def win_07_sequential_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.numbered(_docs(spark, sf_dir).select("source", "doc_id"), ["source", "doc_id"], "nth").select("doc_id", "nth")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) <= 3")
def win_09_topk_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return sampling.top_k_restored(rows, ["l_orderkey"], [F.desc("l_extendedprice")], "l_linenumber", 3).orderBy("l_orderkey", "l_linenumber")


@query("SELECT source, doc_id FROM documents ORDER BY source, doc_id")
def srt_01_plan_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("source", "doc_id").orderBy("source", "doc_id")


@query("SELECT doc_id, printf('spot-%03d', row_number() OVER (ORDER BY sha256('1337|' || doc_id), doc_id)) AS spot_check_id FROM documents ORDER BY sha256('1337|' || doc_id), doc_id LIMIT 100")
def srt_04_spot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.spot_check(_docs(spark, sf_dir).select("doc_id"), "doc_id")


@query("SELECT doc_id, row_number() OVER (ORDER BY coalesce(quality, 0) DESC, doc_id) AS nth FROM documents LEFT JOIN labels USING (doc_id)")
def srt_02_score_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left").select((-F.coalesce("quality", F.lit(0))).alias("q"), "doc_id")
    return sampling.numbered(rows, ["q", "doc_id"], "nth").select("doc_id", "nth")


@query("SELECT o_custkey, o_orderkey, rank::INT AS rank FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 12")
def srt_03_top_by_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.row_number().over(w).alias("rank")).filter("rank <= 12")


# ---------------------------------------------------------------- sets

@query("SELECT doc_id FROM documents UNION SELECT doc_id + 5 FROM labels")
def set_01_union_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id").unionByName(table(spark, sf_dir, "labels").select((C("doc_id") + 5).alias("doc_id"))).distinct()


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels WHERE quality = 1")
def set_03_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id").subtract(table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id"))


@query("SELECT coalesce(a.lang, b.k) AS name, coalesce(n, 0) AS n, coalesce(t, 0.0) AS target FROM (SELECT lang, count(*) AS n FROM documents GROUP BY ALL) a FULL JOIN (VALUES ('en', 0.5::DOUBLE), ('it', 0.1::DOUBLE)) AS b(k, t) ON a.lang = b.k")
def set_04_key_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _docs(spark, sf_dir).groupBy(C("lang").alias("name")).agg(F.count("*").alias("n"))
    targets = spark.createDataFrame([("en", 0.5), ("it", 0.1)], "name string, target double")
    return counts.join(targets, "name", "full").select("name", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("target", F.lit(0.0)).alias("target"))


@query("SELECT 'document' AS kind, doc_id AS id, text AS body FROM documents UNION ALL SELECT 'page', page_id, html FROM pages UNION ALL SELECT 'benchmark', item_id, text FROM benchmark")
def set_05_source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda t, kind, key, body: table(spark, sf_dir, t).select(F.lit(kind).alias("kind"), C(key).alias("id"), C(body).alias("body"))
    return pick("documents", "document", "doc_id", "text").unionByName(pick("pages", "page", "page_id", "html")).unionByName(pick("benchmark", "benchmark", "item_id", "text"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY ALL ORDER BY n DESC, source")
def str_00_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance.distributions(_docs(spark, sf_dir), {"source": "source"}).select(C("value").alias("source"), "n")

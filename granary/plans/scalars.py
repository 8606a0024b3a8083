"""Queries of the scalar functions, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import indicators as I
from granary.functions import text as X
from granary.functions import values as V
from granary.operators import packaging, rules, runs
from granary.plans.base import query, sql_indicators, sql_tokens, table

C = F.col


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query("SELECT doc_id, len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+'))::INT AS words FROM documents")
def str_01_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", X.word_count(C("text")).cast("int").alias("words"))


@query(f"SELECT doc_id, len(t)::INT AS n, md5(array_to_string(list_sort(t), ' ')) AS digest FROM (SELECT doc_id, {sql_tokens('text')} AS t FROM documents)")
def str_02_distinctive_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _docs(spark, sf_dir).select("doc_id", X.distinctive_tokens(C("text")).alias("t"))
    return t.select("doc_id", F.size("t").alias("n"), F.md5(F.array_join(F.array_sort("t"), " ")).alias("digest"))


@query("SELECT conv_id, turn, CASE WHEN contains(r, '</reasoning>') THEN trim(substr(r, strpos(r, '</reasoning>') + 12), ' ' || chr(10)) ELSE '' END AS answer FROM (SELECT *, CASE WHEN turn % 2 = 0 THEN text ELSE 'E1: x</reasoning> ' || text END AS r FROM conversations)")
def str_04_final_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.when(C("turn") % 2 == 0, C("text")).otherwise(F.concat(F.lit("E1: x</reasoning> "), "text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", X.final_answer(r).alias("answer"))


@query("SELECT conv_id, turn, array_to_string(regexp_extract_all('CV1 [applies_to C1]: ' || text || chr(10) || 'CV2 [applies_to C1]: end', '(?m)^CV(\\d+)" + "\\s+\\[applies_to" + "\\s+([^\\]]+)" + "\\]:" + "\\s*(.*)$', 3), '|') AS caveats FROM conversations")
def str_05_caveats(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.concat(F.lit("CV1 [applies_to C1]: "), "text", F.lit("\nCV2 [applies_to C1]: end"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(X.caveats(c), "|").alias("caveats"))


_WITH_PATHS = "text || ' C:' || chr(92) || 'Windows' || chr(92) || 'x' || doc_id || '.exe, /etc/passwd. HKLM' || chr(92) || 'Run' || chr(92) || 'a) event id: 4624; cve-2021-' || (10000 + doc_id % 90000) || ' ' || md5(doc_id::VARCHAR)"


@query(f"SELECT doc_id, array_to_string(list_sort({sql_indicators('t')}), '|') AS indicators FROM (SELECT doc_id, {_WITH_PATHS} AS t FROM documents)")
def str_06_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = C("doc_id").cast("string")
    t = F.concat("text", F.lit(" C:\\Windows\\x"), i, F.lit(".exe, /etc/passwd. HKLM\\Run\\a) event id: 4624; cve-2021-"), (10000 + C("doc_id") % 90000).cast("string"), F.lit(" "), F.md5(i))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(I.indicators(t), "|").alias("indicators"))


@query(f"SELECT page_id, array_to_string(list_sort({sql_indicators('html')}), '|') AS indicators FROM pages")
def str_06_page_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(I.indicators(C("html")), "|").alias("indicators"))


@query("SELECT page_id, concat_ws(chr(10), url, url, html, '{\"page\": ' || page_id || '}') AS corpus FROM pages")
def str_07_source_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = F.concat(F.lit('{"page": '), C("page_id").cast("string"), F.lit("}"))
    return table(spark, sf_dir, "pages").select("page_id", I.source_corpus(C("url"), C("url"), C("html"), meta).alias("corpus"))


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, trim(regexp_replace(p_type || '/' || p_name, '[^A-Za-z0-9_.-]+', '-', 'g'), '-') AS file FROM part")
def str_08_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", X.slug(C("p_name")).alias("slug"), X.file_name(F.concat_ws("/", "p_type", "p_name")).alias("file"))


@query("SELECT doc_id, CASE WHEN length(text) > 900 THEN rtrim(substr(text, 1, 600), ' ' || chr(10)) || chr(10) || chr(10) || '[... middle of the document left out ...]' || chr(10) || chr(10) || ltrim(right(text, 300), ' ' || chr(10)) ELSE text END AS cut FROM documents")
def str_09_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", X.middle_cut(C("text"), 900).alias("cut"))


@query("SELECT doc_id, CASE WHEN length(t) > 500 THEN rtrim(substr(t, 1, 500), ' ' || chr(10)) || chr(10) || '[truncated]' ELSE t END AS cut FROM (SELECT doc_id, trim(text, ' ' || chr(10)) AS t FROM documents)")
def str_10_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", X.limited(C("text"), 500).alias("cut"))


@query("SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS line FROM documents")
def str_11_single_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", X.single_line(C("text")).alias("line"))


@query("SELECT s_suppkey, regexp_replace(lower(s_name), '\\.exe$', '') AS tool FROM supplier")
def str_12_tool_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", X.tool_name(F.concat(F.lit(' "C:\\Tools/bin\\'), "s_name", F.lit('.EXE" '))).alias("tool"))


@query("SELECT doc_id, trim(regexp_replace(replace(text, '|', chr(92) || '|'), '\\s+', ' ', 'g')) AS cell FROM documents")
def str_13_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", X.cell(C("text")).alias("cell"))


@query("SELECT doc_id, (len(list_intersect(list_distinct(regexp_extract_all(lower(text), '[a-zA-Z][\\w.\\\\/-]{2,}')), ['the', 'idiot', 'von', 'que'])) + CASE WHEN contains(lower(text), 'general public license') THEN 1 ELSE 0 END)::INT AS hits FROM documents")
def str_14_term_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", X.matching_terms(C("text"), ["the", "idiot", "von", "que", "general public license"]).cast("int").alias("hits"))


@query("SELECT doc_id, ('0x' || substr(sha256(doc_id::VARCHAR), 1, 12))::BIGINT % 10000 AS bucket FROM documents")
def mth_01_hash_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", V.hash_bucket(C("doc_id").cast("string"), 10_000).alias("bucket"))


@query("SELECT l_orderkey, l_linenumber, least(1.0 * pow(2.0, greatest(l_linenumber - 1, 0)), 30.0) AS delay FROM lineitem")
def mth_06_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", V.backoff(C("l_linenumber")).alias("delay"))


@query("SELECT o_orderkey, round_even(o_orderkey * 0.8::DOUBLE, 0)::BIGINT AS train, round_even(o_orderkey * 0.1::DOUBLE, 0)::BIGINT AS validation, o_orderkey - round_even(o_orderkey * 0.8::DOUBLE, 0)::BIGINT - round_even(o_orderkey * 0.1::DOUBLE, 0)::BIGINT AS test FROM orders")
def mth_07_split_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, c = V.split_sizes(C("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", a.alias("train"), b.alias("validation"), c.alias("test"))


@query("SELECT o_orderkey, o_orderdate::DATE AS d, date_diff('day', DATE '0001-01-01', o_orderdate::DATE)::INT + 1 AS ordinal FROM orders")
def dat_02_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.iso_date(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", d.alias("d"), V.ordinal(d).alias("ordinal"))


@query("SELECT event_id, epoch_us(ts) AS us FROM events")
def dat_01_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return table(spark, sf_dir, "events").select("event_id", F.unix_micros(V.timestamp(iso)).alias("us"))


@query("SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''), '|') AS items FROM documents")
def arr_01_as_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.array_join(V.as_list(F.split("text", "\n")), "|").alias("items"))


@query("WITH t AS (SELECT doc_id, unnest(string_split(text, ' ')) AS x, unnest(range(len(string_split(text, ' ')))) AS i FROM documents), f AS (SELECT doc_id, x, min(i) AS i FROM t WHERE x <> '' GROUP BY ALL) SELECT d.doc_id, coalesce(string_agg(x, ' ' ORDER BY i), '') AS words FROM documents d LEFT JOIN f ON f.doc_id = d.doc_id GROUP BY d.doc_id")
def set_06_ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.array_join(V.ordered_distinct(F.split("text", " ")), " ").alias("words"))


@query("SELECT event_id, user_id % 7 = 3 OR user_id % 7 > 3 AS passes FROM events")
def val_18_order_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = "informational low medium high critical".split()
    level = F.element_at(F.array(*[F.lit(x) for x in ["unknown", "odd", *order]]), (C("user_id") % 7 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", V.at_least(level, "low", order).alias("passes"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN trim(text, ' ' || chr(10)) ELSE trim(text, ' ' || chr(10)) END AS body FROM documents")
def jsn_02_fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    fenced = F.when(C("doc_id") % 3 == 0, F.concat(F.lit("```json\n"), "text", F.lit("\n```"))).otherwise(C("text"))
    return _docs(spark, sf_dir).select("doc_id", X.json_fence(fenced).alias("body"))


@query("SELECT event_id, user_id, value FROM events")
def jsn_01_json_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a JSON object among text or in a fence, found again."""
    body = F.to_json(F.struct("event_id", "user_id", "value"))
    answer = F.when(C("event_id") % 3 == 0, body).when(C("event_id") % 3 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(F.concat(F.lit("Here {it} is: "), body, F.lit(" as asked.")))
    v = F.from_json(V.json_object(answer), "event_id bigint, user_id bigint, value double")
    return table(spark, sf_dir, "events").select(v.alias("v")).select("v.*")


@query("SELECT page_id, url, 'lang: ' || substr(html, strpos(html, 'lang=\"') + 6, 2) AS head, html AS body FROM pages")
def src_17_front_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.concat(F.lit("---\nlang: "), F.regexp_extract("html", 'lang="(..)', 1), F.lit("\n---\n"), "html")
    head, body = X.front_matter(t)
    return table(spark, sf_dir, "pages").select("page_id", "url", head.alias("head"), body.alias("body"))


@query("SELECT doc_id, sha256('Source $source of $unknown, ' || lang || ': ' || text) AS prompt_hash FROM documents")
def prj_05_prompt_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = runs.prompt_text("Source $source of $unknown, ${lang}: $text", {"lang": C("lang"), "text": C("text")})
    return _docs(spark, sf_dir).select("doc_id", F.sha2(prompt, 256).alias("prompt_hash"))


@query("SELECT doc_id, CASE WHEN w < 250 THEN 1 ELSE least(5, CASE WHEN source = 'src3' THEN 2 ELSE 5 END, CASE WHEN lang = 'de' THEN 3 ELSE 5 END) END AS pairs FROM (SELECT *, len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) AS w FROM documents)")
def prj_07_pairs_per_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = runs.pairs_per_document(X.word_count(C("text")), F.lit(5), C("source") == "src3", F.when(C("lang") == "de", 3))
    return _docs(spark, sf_dir).select("doc_id", n.alias("pairs"))


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 'W1,W2,S3' WHEN 'de' THEN 'W1,S3' WHEN 'fr' THEN 'L1' ELSE 'S1' END AS refs FROM documents")
def prj_08_taxonomy_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = lambda *x: F.array(*map(F.lit, x))  # noqa: E731, E741
    refs = runs.taxonomy_refs(F.when(C("lang") == "en", l("W1", "W2")), F.when(C("lang").isin("en", "de"), l("W1", "S3")), fallback=F.when(C("lang") == "fr", l("L1")))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(refs, ",").alias("refs"))


@query("SELECT doc_id, 'Again.' || chr(10) || chr(10) || 'The last answer had these problems:' || chr(10) || '- ' || array_to_string(string_split(text, chr(10))[1:12], chr(10) || '- ') || CASE WHEN len(string_split(text, chr(10))) > 12 THEN chr(10) || '- and ' || (len(string_split(text, chr(10))) - 12) || ' more' ELSE '' END AS prompt FROM documents")
def prj_10_retry_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", runs.retry_prompt(F.lit("Again."), F.split("text", "\n")).alias("prompt"))


@query("SELECT item_id, CASE WHEN item_id % 2 = 0 THEN 'Context:' || chr(10) || 'item ' || item_id || chr(10) || chr(10) ELSE '' END || 'Question:' || chr(10) || trim(text, ' ' || chr(10)) || chr(10) || chr(10) || 'Answer in JSON.' AS content FROM benchmark")
def prj_11_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from granary.operators.evaluation import messages

    m = messages("Be exact.", F.when(C("item_id") % 2 == 0, F.concat(F.lit("item "), C("item_id").cast("string"))), C("text"), F.lit("Answer in JSON."))
    return table(spark, sf_dir, "benchmark").select("item_id", F.element_at(m, 2)["content"].alias("content"))


@query("SELECT page_id, trim(regexp_replace(lower(regexp_replace(url, '[^\\p{L}\\p{N}]', '_', 'g')), '^_+|_+$', '', 'g')) AS label FROM pages")
def prj_13_run_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.label(C("url")).alias("label"))


@query("SELECT doc_id, trim(array_to_string(list_transform(string_split(replace(replace(replace('<reasoning>' || chr(10) || text || '  ' || chr(10) || '</reasoning> [GENERAL KNOWLEDGE]', '[GENERAL KNOWLEDGE]', ''), '<reasoning>', '<think>'), '</reasoning>', '</think>'), chr(10)), lambda x: rtrim(x, ' ' || chr(9))), chr(10)), ' ' || chr(10)) AS content FROM documents")
def prj_04_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.concat(F.lit("<reasoning>\n"), "text", F.lit("  \n</reasoning> [GENERAL KNOWLEDGE]"))
    return _docs(spark, sf_dir).select("doc_id", packaging.model_view(c)[0].alias("content"))


@query("SELECT doc_id, contains(text, '[GENERAL KNOWLEDGE]') OR doc_id % 2 = 1 AS mismatch FROM documents")
def val_09_tag_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.when(C("doc_id") % 2 == 1, F.concat("text", F.lit(" [General Knowledge]"))).otherwise(C("text"))
    return _docs(spark, sf_dir).select("doc_id", (F.size(rules.grounding(F.lit("source_only"), t)) > 0).alias("mismatch"))

"""Collectors: nested records of a source as documents of one shape.

Each takes what its reader gives (YAML documents as JSON text with their path, or parsed STIX and catalogue files) and
returns (doc_id, source, title, date_published, content_type, content_markdown, metadata_json, word_count, source_path).
Everything between parsing and writing is a column expression; groups and argmaxes are aggregates with map-side parts.
Repositories and feeds are fetched by the operator of the cluster, not here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import text as X
from granary.functions import values as V
from granary.operators.sampling import keep_first

LEVELS = "informational low medium high critical".split()
TACTICS = sorted("impact exfiltration command_and_control collection lateral_movement discovery credential_access defense_impairment stealth privilege_escalation persistence execution initial_access resource_development reconnaissance".split(), key=len)


def lines(*parts: Column | str) -> Column:
    """Parts (strings, or arrays of strings) as lines; null parts are left out."""
    return X.strip(F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts]))


def section(heading: str, body: Column) -> Column:
    """A heading with its lines and a blank line after; null where body, an array or a text, has nothing."""
    return F.when(F.length(F.concat_ws("\n", body)) > 0, F.concat(F.lit(f"## {heading}\n"), F.concat_ws("\n", body), F.lit("\n")))


def bullets(items: Column, form: str = "- %s") -> Column:
    return F.transform(V.as_list(F.coalesce(items, F.array().cast("array<string>"))), lambda x: F.format_string(form, x))


def field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"**{name}**: "), F.coalesce(value.cast("string"), F.lit("")))


def _document(rows: DataFrame, source: str, kind: str, doc_id: Column, title: Column, markdown: Column, meta: Column, date: Column | None = None, path: str = "source_path") -> DataFrame:
    made = rows.select(
        doc_id.alias("doc_id"), F.lit(source).alias("source"), title.alias("title"), (date if date is not None else F.lit(None)).cast("timestamp").alias("date_published"), F.lit(kind).alias("content_type"),
        markdown.alias("content_markdown"), F.to_json(meta).alias("metadata_json"), F.col(path).alias("source_path"),
    )
    return made.withColumn("word_count", X.word_count(F.col("content_markdown")).cast("bigint"))


def _parsed(found: DataFrame, schema: str) -> DataFrame:
    """YAML documents with a record r; those that don't parse, or aren't mappings, are left out."""
    good = found.filter("error is null").withColumn("r", F.from_json("json", schema)).filter(F.regexp_like("json", F.lit(r"\A\s*\{")))
    return good.select(F.col("file_path").alias("source_path"), "nth", "json", "r")


_RULE = "id string, title string, description string, status string, level string, author string, date string, modified string, logsource struct<product:string,category:string,service:string,definition:string>, detection string, details string, tags array<string>, falsepositives array<string>, references array<string>, ruletype string"


def _rule_markdown(r: Column) -> Column:
    source = F.array_compact(F.array(*[F.when(F.coalesce(r["logsource"][k], F.lit("")) != "", F.concat(F.lit(f"- **{k.capitalize()}**: "), r["logsource"][k])) for k in "product category service definition".split()]))
    fenced = F.when(r["detection"].isNotNull(), F.concat(F.lit("```\n"), r["detection"], F.lit("\n```")))
    return lines(
        F.concat(F.lit("# "), F.coalesce(r["title"], F.lit("Untitled"))), "", field("Status", F.coalesce(r["status"], F.lit("unknown"))), field("Level", F.coalesce(r["level"], F.lit("unknown"))), field("Author", r["author"]), field("Date", r["date"]), "",
        section("Description", F.coalesce(r["description"], F.lit("None given."))), section("Log source", source), section("Detection", fenced), section("Alert details", F.coalesce(r["details"], F.lit(""))),
        section("Tags", bullets(r["tags"], "- `%s`")), section("False positives", bullets(r["falsepositives"])), section("References", bullets(r["references"])),
    )


def techniques_of(tags: Column) -> Column:
    """Technique ids of rule tags; tactic ids such as TA0005 come along, as they begin alike."""
    low = F.transform(F.coalesce(tags, F.array().cast("array<string>")), F.lower)
    return F.transform(F.filter(low, lambda t: F.startswith(t, F.lit("attack.t")) & ~F.startswith(t, F.lit("attack.the"))), lambda t: F.upper(F.replace(t, F.lit("attack."), F.lit(""))))


def tactics_of(tags: Column) -> Column:
    low = F.transform(F.coalesce(tags, F.array().cast("array<string>")), F.lower)
    names = F.transform(F.filter(low, lambda t: F.startswith(t, F.lit("attack."))), lambda t: F.replace(F.replace(t, F.lit("attack."), F.lit("")), F.lit("-"), F.lit("_")))
    return F.filter(names, lambda t: t.isin(TACTICS))


def _rules(found: DataFrame, minimum: str) -> DataFrame:
    rows = _parsed(found, _RULE)
    return rows.withColumn("level", F.lower(F.coalesce(F.col("r.level"), F.lit("unknown")))).filter(V.at_least(F.col("level"), minimum, LEVELS))


def _rule_meta(*more: Column) -> Column:
    r = F.col("r")
    return F.struct(r["id"].alias("rule_id"), "level", r["status"].alias("status"), *[r["logsource"][k].alias(f"logsource_{k}") for k in ("product", "category", "service")], r["falsepositives"].alias("falsepositives"), r["author"].alias("author"), *more)


def sigma(found: DataFrame, minimum: str = "low") -> DataFrame:
    """Detection rules of at least the minimum level; one without an id goes by its file's name."""
    rows = _rules(found, minimum)
    r = F.col("r")
    key = F.coalesce(r["id"], F.regexp_extract("source_path", r"([^/]*?)(?:\.[^./]*)?$", 1))
    meta = _rule_meta(techniques_of(r["tags"]).alias("mitre_attack_ids"), tactics_of(r["tags"]).alias("mitre_attack_tactics"))
    return _document(rows, "sigma_rules", "sigma_rule", F.concat(F.lit("sigma-"), key), F.coalesce(r["title"], F.lit("Untitled")), _rule_markdown(r), meta, V.timestamp(r["date"]))


def hayabusa(found: DataFrame, minimum: str = "low") -> DataFrame:
    """Rules with an id; of equal ids the first in path order stays."""
    rows = _rules(found, minimum).filter(F.coalesce(F.col("r.id"), F.lit("")) != "")
    rows = keep_first(rows.withColumn("key", F.col("r.id")), ["key"], ["source_path", "nth"])
    r = F.col("r")
    meta = _rule_meta(r["tags"].alias("tags"), r["references"].alias("references"), r["modified"].alias("modified"), r["ruletype"].alias("ruletype"), r["details"].alias("details_format"))
    return _document(rows, "hayabusa_rules", "hayabusa_rule", F.concat(F.lit("hayabusa-"), "key"), F.coalesce(r["title"], F.lit("Untitled")), _rule_markdown(r), meta, V.timestamp(r["date"]))


_ATOMIC = "attack_technique string, display_name string, atomic_tests array<struct<name:string,description:string,auto_generated_guid:string,supported_platforms:array<string>,input_arguments:map<string,struct<description:string,type:string,default:string>>,dependency_executor_name:string,dependencies:array<struct<description:string,prereq_command:string,get_prereq_command:string>>,executor:struct<name:string,elevation_required:boolean,command:string,cleanup_command:string>>>"


def atomic_tests(found: DataFrame) -> DataFrame:
    """One document for each test of files in folders named T..."""
    rows = _parsed(found, _ATOMIC).filter(F.regexp_like("source_path", F.lit(r"/T[^/]*/[^/]*$"))).select("source_path", "r", F.posexplode("r.atomic_tests").alias("i", "t"))
    t, tid = F.col("t"), F.coalesce(F.col("r.attack_technique"), F.regexp_extract("source_path", r"/(T[^/]*)/[^/]*$", 1))
    name = F.coalesce(t["name"], F.format_string("%s - Test %d", tid, "i"))
    shown = F.coalesce(F.col("r.display_name"), tid)
    arguments = F.transform(F.map_entries(F.coalesce(t["input_arguments"], F.create_map().cast("map<string,struct<description:string,type:string,default:string>>"))), lambda e: F.format_string("| `%s` | %s | %s | `%s` |", e["key"], X.cell(F.coalesce(e["value"]["description"], F.lit(""))), F.coalesce(e["value"]["type"], F.lit("string")), X.cell(F.coalesce(e["value"]["default"], F.lit("")))))
    table = F.when(F.size(arguments) > 0, F.concat(F.array(F.lit("| Name | Description | Type | Default |"), F.lit("|---" * 4 + "|")), arguments))
    needs = F.transform(t["dependencies"], lambda d: F.concat_ws("\n", F.concat(F.lit("- "), F.coalesce(d["description"], F.lit(""))), F.concat(F.lit("  - Check: `"), X.strip(d["prereq_command"]), F.lit("`")), F.concat(F.lit("  - Install: `"), X.strip(d["get_prereq_command"]), F.lit("`"))))
    x = t["executor"]
    block = lambda title, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"### {title}\n```"), F.coalesce(x["name"], F.lit("")), F.lit("\n"), X.strip(c), F.lit("\n```\n")))
    runner = F.when(x.isNotNull(), F.concat_ws("\n", field("Type", F.coalesce(x["name"], F.lit("unknown"))), field("Elevation required", F.coalesce(x["elevation_required"], F.lit(False))), F.lit(""), block("Command", x["command"]), block("Cleanup command", x["cleanup_command"])))
    body = lines(F.concat(F.lit("# "), tid, F.lit(": "), name), "", field("Technique", F.concat(shown, F.lit(" ("), tid, F.lit(")"))), field("Platforms", F.array_join(t["supported_platforms"], ", ")), field("GUID", F.concat(F.lit("`"), t["auto_generated_guid"], F.lit("`"))), "", section("Description", F.coalesce(t["description"], F.lit("None given."))), section("Input arguments", F.coalesce(table, F.array().cast("array<string>"))), section("Dependencies", F.coalesce(needs, F.array().cast("array<string>"))), section("Executor", F.coalesce(runner, F.lit(""))))
    meta = F.struct(tid.alias("technique_id"), shown.alias("display_name"), t["auto_generated_guid"].alias("test_guid"), F.col("i").alias("test_index"), t["supported_platforms"].alias("supported_platforms"), F.coalesce(x["name"], F.lit("unknown")).alias("executor_type"), F.coalesce(x["elevation_required"], F.lit(False)).alias("elevation_required"), (F.coalesce(x["cleanup_command"], F.lit("")) != "").alias("has_cleanup"), (F.size(F.coalesce(t["dependencies"], F.array().cast("array<struct<description:string,prereq_command:string,get_prereq_command:string>>"))) > 0).alias("has_dependencies"))
    return _document(rows, "atomic_red_team", "atomic_test", F.concat(F.lit("atomic-rt-"), t["auto_generated_guid"]), F.concat(tid, F.lit(": "), name), body, meta)


KEV = "catalogVersion string, dateReleased string, vulnerabilities array<struct<cveID:string,vendorProject:string,product:string,vulnerabilityName:string,dateAdded:string,shortDescription:string,requiredAction:string,dueDate:string,knownRansomwareCampaignUse:string,notes:string,cwes:array<string>>>"


def kev(catalogue: DataFrame, least: int = 1) -> DataFrame:
    """One document for each vendor of a catalogue (read with the schema KEV) that has at least so many entries."""
    each = catalogue.select("catalogVersion", "dateReleased", F.posexplode("vulnerabilities").alias("i", "v"))
    v = F.col("v")
    known = F.lower(F.coalesce(v["knownRansomwareCampaignUse"], F.lit(""))) == "known"
    yes = F.when(known, "Yes").otherwise("No")
    some = lambda c, d="N/A": F.coalesce(c, F.lit(d))
    row = F.concat_ws(" | ", some(v["cveID"]), some(v["product"]), some(v["vulnerabilityName"]), yes, some(v["dueDate"]))
    detail = F.concat_ws(
        "\n", F.concat(F.lit("### "), some(v["cveID"]), F.lit(": "), some(v["vulnerabilityName"], "")), F.concat(F.lit("- **Product**: "), some(v["product"])), F.concat(F.lit("- **Date Added**: "), some(v["dateAdded"], "")), F.concat(F.lit("- **Due Date**: "), some(v["dueDate"], "")), F.concat(F.lit("- **Ransomware**: "), yes),
        F.when(some(v["requiredAction"], "") != "", F.concat(F.lit("- **Required Action**: "), v["requiredAction"])), F.when(some(v["notes"], "") != "", F.concat(F.lit("- **Notes**: "), v["notes"])), F.concat(F.lit("- **CWEs**: "), some(F.array_join(v["cwes"], ", "))), F.concat(F.lit("- **Description**: "), some(v["shortDescription"], "")), F.lit(""),
    )
    g = each.groupBy(some(v["vendorProject"], "Unknown").alias("vendor"), "catalogVersion", "dateReleased").agg(
        F.count("*").alias("n"), F.count_if(known).alias("ransom"), F.array_sort(F.collect_set(some(v["product"], "Unknown"))).alias("products"),
        F.transform(F.array_sort(F.collect_list(F.struct(some(v["dateAdded"], ""), "i", row))), lambda x: F.concat(F.lit("| "), x["col3"], F.lit(" |"))).alias("rows"),
        F.transform(F.array_sort(F.collect_list(F.struct("i", detail))), lambda x: x["col2"]).alias("details"),
        F.transform(F.array_sort(F.collect_list(F.struct("i", v["cveID"].alias("c")))), lambda x: x["c"]).alias("cves"),
    ).filter(F.col("n") >= least)
    head = F.array(F.lit("| CVE | Product | Vulnerability | Ransomware | Due date |"), F.lit("|---" * 5 + "|"))
    body = lines(F.concat(F.lit("# CISA KEV: "), "vendor"), "", field("Vendor", F.col("vendor")), field("Products", F.array_join("products", ", ")), field("Total CVEs", F.col("n")), field("Ransomware-linked", F.col("ransom")), "", section("Vulnerabilities", F.concat(head, "rows")), "## Details", "", F.col("details"))
    key = F.substring(F.replace(F.replace(F.lower("vendor"), F.lit(" "), F.lit("-")), F.lit("/"), F.lit("-")), 1, 50)
    meta = F.struct("vendor", "products", V.as_list(F.col("cves")).alias("cve_ids"), F.col("n").alias("cve_count"), F.col("ransom").alias("ransomware_linked_count"), F.col("catalogVersion").alias("catalog_version"))
    return _document(g.withColumn("source_path", F.lit(None).cast("string")), "cisa_kev", "vulnerability_catalog", F.concat(F.lit("kev-"), key), F.format_string("CISA KEV: %s (%d CVEs)", "vendor", "n"), body, meta, V.timestamp(F.col("dateReleased")))


_OSSEM = "name string, description string, event_id string, event_version string, platform string, log_source string, tags array<string>, event_fields array<struct<name:string,standard_name:string,standard_type:string,type:string,description:string,sample_value:string>>, references array<struct<text:string,name:string,link:string,url:string>>"


def ossem(found: DataFrame) -> DataFrame:
    """One event dictionary for each platform, log source and event id: that of the highest version, then of most described fields, most fields and last path."""
    rows = _parsed(found, _OSSEM)
    r = F.col("r")
    fields = F.filter(F.transform(r["event_fields"], lambda f: F.struct(F.coalesce(F.nullif(f["name"], F.lit("")), f["standard_name"]).alias("name"), f["type"].alias("type"), f["description"].alias("description"), f["sample_value"].alias("sample_value"), F.nullif(f["standard_name"], F.lit("TBD")).alias("standard_name"), F.nullif(f["standard_type"], F.lit("TBD")).alias("standard_type"))), lambda f: F.coalesce(f["name"], F.lit("")) != "")
    rows = rows.withColumn("fields", fields).filter(F.size("fields") > 0)
    version = F.transform(F.regexp_extract_all(F.coalesce(r["event_version"], F.lit("")), F.lit(r"(\d+)"), F.lit(1)), lambda x: x.cast("bigint"))
    version = F.when(F.size(version) > 0, version).otherwise(F.array(F.lit(0).cast("bigint")))
    score = F.struct(version.alias("v"), F.size(F.filter("fields", lambda f: F.coalesce(f["description"], F.lit("")) != "")).alias("d"), F.size("fields").alias("n"), "source_path")
    blank = F.coalesce(F.trim(r["event_id"]), F.lit("")) == ""
    part = lambda c: F.when(blank, F.lit("")).otherwise(F.coalesce(F.trim(c), F.lit("")))
    best = rows.groupBy(F.when(blank, F.col("source_path")).otherwise(part(r["platform"])).alias("g1"), part(r["log_source"]).alias("g2"), part(r["event_id"]).alias("g3"), blank.alias("g4")).agg(F.max_by(F.struct("source_path", "r", "fields"), score).alias("b")).select("b.*")
    line = F.transform("fields", lambda f: F.concat(F.lit("| "), F.concat_ws(" | ", *[X.cell(F.coalesce(f[k], F.lit(""))) for k in ("standard_name", "name", "type", "description", "sample_value")]), F.lit(" |")))
    head = F.array(F.lit("| Standard name | Name | Type | Description | Sample |"), F.lit("|---" * 5 + "|"))
    links = F.transform(r["references"], lambda x: F.concat_ws(" ", F.coalesce(x["text"], x["name"]), F.coalesce(x["link"], x["url"])))
    body = lines(F.concat(F.lit("# "), r["name"]), "", field("Event ID", r["event_id"]), field("Version", r["event_version"]), field("Platform", r["platform"]), field("Log source", r["log_source"]), "", section("Description", F.coalesce(r["description"], F.lit(""))), section("Fields", F.concat(head, line)), section("References", bullets(links)))
    name = F.coalesce(F.nullif(r["name"], F.lit("")), F.regexp_extract("source_path", r"([^/]*?)(?:\.[^./]*)?$", 1))
    meta = F.struct(r["event_id"].alias("event_id"), name.alias("event_name"), r["event_version"].alias("event_version"), r["platform"].alias("platform"), r["log_source"].alias("log_source"), F.size("fields").alias("field_count"), F.transform("fields", lambda f: f["name"]).alias("field_names"), "source_path", r["tags"].alias("tags"))
    return _document(best, "ossem_data_dicts", "event_dictionary", F.concat(F.lit("ossem-"), X.slug(F.regexp_replace("source_path", r"\.[^./]*$", ""), "entry")), F.concat(F.lit("OSSEM: "), name), body, meta)


STIX = "objects array<struct<id:string,type:string,name:string,description:string,created:string,revoked:boolean,x_mitre_deprecated:boolean,x_mitre_is_subtechnique:boolean,x_mitre_platforms:array<string>,x_mitre_contributors:array<string>,x_mitre_analytic_refs:array<string>,kill_chain_phases:array<struct<kill_chain_name:string,phase_name:string>>,external_references:array<struct<source_name:string,external_id:string,url:string>>,relationship_type:string,source_ref:string,target_ref:string>>"


def attack(bundle: DataFrame, with_retired: bool = False) -> DataFrame:
    """One document for each technique of a STIX bundle (read with the schema STIX), with procedures, mitigations and detections joined to it."""
    o = bundle.select(F.explode("objects").alias("o")).select("o.*")
    live = o if with_retired else o.filter(~F.coalesce("revoked", F.lit(False)) & ~F.coalesce("x_mitre_deprecated", F.lit(False)))
    external = F.try_element_at(F.filter("external_references", lambda r: r["source_name"] == "mitre-attack"), F.lit(1))["external_id"]
    techniques = live.filter("type = 'attack-pattern'").withColumn("tid", F.coalesce(external, F.lit("")))
    links = o.filter("type = 'relationship'").select("relationship_type", "source_ref", "target_ref", F.col("description").alias("said"))
    names = o.filter("type <> 'relationship'").select(F.col("id").alias("source_ref"), F.col("name").alias("who"), F.col("type").alias("kind"), F.col("x_mitre_analytic_refs").alias("analytics"))
    joined = links.join(names, "source_ref")
    told = joined.filter("relationship_type in ('uses', 'mitigates')").select("target_ref", F.col("relationship_type").alias("rel"), "who", F.concat(F.lit("**"), "who", F.lit("**: "), F.coalesce("said", F.lit(""))).alias("line"))
    texts = o.filter("type <> 'relationship'").select(F.col("id").alias("analytic"), F.col("description").alias("text"))
    seen = joined.filter("relationship_type = 'detects'").select("target_ref", "who", F.posexplode_outer("analytics").alias("i", "analytic")).join(texts, "analytic", "left")
    seen = seen.groupBy("target_ref", "who").agg(F.array_sort(F.collect_list(F.when(F.coalesce("text", F.lit("")) != "", F.struct("i", "text")))).alias("t"))
    found = F.array_join(F.transform("t", lambda x: x["text"]), " ")
    seen = seen.select("target_ref", F.lit("detects").alias("rel"), "who", F.concat(F.lit("**"), "who", F.lit("**: "), F.when(found == "", "No description available.").otherwise(found)).alias("line"))
    listed = told.unionByName(seen).groupBy("target_ref").pivot("rel", ["uses", "mitigates", "detects"]).agg(F.transform(F.array_sort(F.collect_list(F.struct("who", "line"))), lambda x: x["line"]))
    parents = links.filter("relationship_type = 'subtechnique-of'").select(F.col("source_ref").alias("child"), "target_ref").join(techniques.select(F.col("id").alias("target_ref"), F.col("tid").alias("parent")), "target_ref").groupBy("child").agg(F.min("parent").alias("parent"))
    rows = techniques.join(listed.withColumnRenamed("target_ref", "id"), "id", "left").join(parents.withColumnRenamed("child", "id"), "id", "left")
    tactics = F.transform(F.filter("kill_chain_phases", lambda k: k["kill_chain_name"] == "mitre-attack"), lambda k: k["phase_name"])
    body = lines(F.concat(F.lit("# "), "tid", F.lit(": "), "name"), "", field("Tactics", F.array_join(tactics, ", ")), field("Platforms", F.array_join("x_mitre_platforms", ", ")), "", section("Description", F.coalesce("description", F.lit(""))), section("Procedures", bullets(F.col("uses"))), section("Mitigations", bullets(F.col("mitigates"))), section("Detections", bullets(F.col("detects"))))
    meta = F.struct(F.transform("external_references", lambda r: F.array(F.coalesce(r["source_name"], F.lit("")), F.coalesce(r["url"], F.lit("")))).alias("data_sources"), F.coalesce("parent", F.lit("")).alias("parent_technique"), F.coalesce("x_mitre_contributors", F.array().cast("array<string>")).alias("contributors"))
    return _document(rows.withColumn("source_path", F.col("id")), "mitre_attack", "technique_definition", F.concat(F.lit("mitre-attack-"), "tid"), F.col("name"), body, meta, V.timestamp(F.col("created")))


def manifest(docs: DataFrame) -> DataFrame:
    """(collector, document_count, distinct_docs, empty) of all collected documents."""
    return docs.groupBy(F.col("source").alias("collector")).agg(F.count("*").alias("document_count"), F.countDistinct("doc_id").alias("distinct_docs"), F.count_if(F.col("word_count") == 0).alias("empty"))

"""Further collectors: KAPE, LOLBAS and GTFOBins, ForensicArtifacts, Velociraptor, HijackLibs, LOLDrivers, CSAF advisories, ATLAS and skills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import text as X
from granary.functions import values as V
from granary.sources.collectors import _document, _parsed, bullets, field, lines, section

STRINGS = "array<string>"


def flexible(c: Column) -> Column:
    """A field read as a string that may hold one value or a JSON list of them: its values, without empties."""
    many = F.from_json(c, STRINGS)
    return V.as_list(F.when(F.startswith(c, F.lit("[")), many).otherwise(V.scalar_list(c)))


def _stem() -> Column:
    return F.regexp_extract("source_path", r"([^/]*?)(?:\.[^./]*)?$", 1)


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _distinct_sorted(c: Column) -> Column:
    return F.array_sort(F.array_distinct(V.as_list(c)))


def _slug_path() -> Column:
    return X.slug(F.regexp_replace("source_path", r"\.[^./]*$", ""), "entry")


_KAPE = "Description string, Author string, Version string, Id string, Targets array<struct<Name:string,Category:string,Path:string,FileMask:string,Recursive:string,Comment:string,SaveAsFileName:string>>, Category string, BinaryUrl string, Processors array<struct<Executable:string,CommandLine:string,ExportFormat:string>>"


def kape(found: DataFrame) -> DataFrame:
    """Targets (.tkape) and modules (.mkape) outside of !Disabled folders."""
    rows = _parsed(found, _KAPE).filter(~F.contains("source_path", F.lit("/!Disabled/")))
    r = F.col("r")
    target = F.endswith(F.lower("source_path"), F.lit(".tkape"))
    opt = lambda name, c: F.when(_text(c) != "", F.concat(F.lit(f"- **{name}**: "), c))
    parts = F.transform(r["Targets"], lambda t: F.concat_ws("\n", F.concat(F.lit("### "), F.coalesce(t["Name"], F.lit("Unnamed"))), opt("Category", t["Category"]), opt("Path", t["Path"]), opt("File mask", t["FileMask"]), opt("Recursive", t["Recursive"]), opt("Comment", t["Comment"]), opt("Save as", t["SaveAsFileName"])))
    runs = F.transform(r["Processors"], lambda p: F.concat_ws("\n", F.concat(F.lit("- **"), _text(p["Executable"]), F.lit("**: `"), _text(p["CommandLine"]), F.lit("`"))))
    empty = F.array().cast(STRINGS)
    kind = F.when(target, "Target").otherwise("Module")
    body = lines(F.concat(F.lit("# KAPE "), kind, F.lit(": "), _stem()), "", field("Description", r["Description"]), field("Author", F.coalesce(r["Author"], F.lit("Unknown"))), field("Version", r["Version"]), "", section("Targets", F.coalesce(parts, empty)), section("Processors", F.coalesce(runs, empty)))
    categories = F.when(target, _distinct_sorted(F.coalesce(F.transform(r["Targets"], lambda t: t["Category"]), empty))).otherwise(V.scalar_list(r["Category"]))
    meta = F.struct(F.lower(kind).alias("kape_type"), F.coalesce(r["Id"], _stem()).alias("guid"), r["Author"].alias("author"), r["Version"].alias("version"), V.as_list(F.coalesce(F.transform(r["Targets"], lambda t: t["Path"]), empty)).alias("artifact_paths"), categories.alias("categories"), F.size(F.coalesce(r["Targets"], F.from_json(F.lit("[]"), "array<struct<Name:string,Category:string,Path:string,FileMask:string,Recursive:string,Comment:string,SaveAsFileName:string>>"))).alias("target_count"))
    return _document(rows, "kape_files", "artifact_definition", F.concat(F.lit("kape-"), F.lower(kind), F.lit("-"), F.lower(_stem())), F.concat(F.lit("KAPE "), kind, F.lit(": "), _stem()), body, meta)


_LOLBAS = "Name string, Description string, Author string, Aliases string, Full_Path string, Commands array<struct<Command:string,Description:string,Usecase:string,Category:string,Privileges:string,MitreID:string,OperatingSystem:string>>, Detection string, Resources string"


def lolbas(found: DataFrame, paths_shown: int = 20) -> DataFrame:
    """One entry a file; one that has aliases but no commands is of a content type of its own."""
    rows = _parsed(found, _LOLBAS)
    r = F.col("r")
    of = lambda c, k: F.when(F.contains(_text(c), F.lit(f'"{k}"')), V.as_list(F.transform(F.from_json(c, f"array<struct<{k}:string>>"), lambda x: x[k]))).otherwise(flexible(c))
    aliases, paths = of(r["Aliases"], "Alias"), of(r["Full_Path"], "Path")
    shown = F.concat(bullets(F.slice(paths, 1, paths_shown), "- `%s`"), F.when(F.size(paths) > paths_shown, F.array(F.format_string("- and %d more", F.size(paths) - paths_shown))).otherwise(F.array().cast(STRINGS)))
    cmds = F.transform(r["Commands"], lambda c: F.concat_ws("\n", F.concat(F.lit("### "), F.coalesce(c["Category"], F.lit("Command"))), F.concat(F.lit("```\n"), _text(c["Command"]), F.lit("\n```")), c["Description"], F.concat(F.lit("- **Use**: "), c["Usecase"]), F.concat(F.lit("- **Technique**: "), c["MitreID"]), F.concat(F.lit("- **Privileges**: "), c["Privileges"])))
    empty = F.array().cast(STRINGS)
    alias_only = (F.size(aliases) > 0) & (F.size(F.coalesce(cmds, empty)) == 0)
    name = F.coalesce(r["Name"], _stem())
    body = lines(F.concat(F.lit("# LOLBAS: "), name), "", field("Platform", F.lit("Windows")), field("Description", r["Description"]), field("Aliases", F.array_join(aliases, ", ")), "", section("Full paths", shown), section("Abuse functions", F.coalesce(cmds, empty)))
    meta = F.struct(name.alias("name"), aliases.alias("aliases"), paths.alias("full_paths"), _distinct_sorted(F.coalesce(F.transform(r["Commands"], lambda c: c["MitreID"]), empty)).alias("mitre_attack_ids"), _distinct_sorted(F.coalesce(F.transform(r["Commands"], lambda c: c["Category"]), empty)).alias("categories"))
    out = _document(rows.withColumn("alias_only", alias_only).withColumn("kind_path", F.concat_ws("\x01", F.when(alias_only, "alias").otherwise("full"), "source_path")), "lolbas", "lolbas_entry", F.concat(F.lit("lolbas-"), X.slug(name)), F.concat(F.lit("LOLBAS: "), name), body, meta, path="kind_path")
    return out.withColumn("content_type", F.when(F.startswith("source_path", F.lit("alias")), "lolbas_alias").otherwise(F.col("content_type"))).withColumn("source_path", F.substring_index("source_path", "\x01", -1))


def gtfobins(found: DataFrame) -> DataFrame:
    """One binary a file: its functions, each with its code in one or more contexts."""
    rows = _parsed(found, "description string, functions map<string,array<struct<code:string,comment:string>>>")
    e = F.map_entries(F.coalesce(F.col("r.functions"), F.create_map().cast("map<string,array<struct<code:string,comment:string>>>")))
    parts = F.transform(e, lambda f: F.concat(F.lit("### "), f["key"], F.lit("\n"), F.array_join(F.transform(f["value"], lambda x: F.concat_ws("\n", x["comment"], F.concat(F.lit("```\n"), _text(x["code"]), F.lit("\n```")))), "\n")))
    body = lines(F.concat(F.lit("# GTFOBins: "), _stem()), "", field("Platform", F.lit("Linux")), "", section("Description", _text(F.col("r.description"))), section("Functions", parts))
    meta = F.struct(_stem().alias("name"), F.array_sort(F.map_keys(F.coalesce(F.col("r.functions"), F.create_map().cast("map<string,array<struct<code:string,comment:string>>>")))).alias("functions"))
    return _document(rows, "gtfobins", "gtfobins_entry", F.concat(F.lit("gtfobins-"), X.slug(_stem())), F.concat(F.lit("GTFOBins: "), _stem()), body, meta)


_ARTIFACT = "name string, doc string, supported_os array<string>, urls array<string>, sources array<struct<type:string,supported_os:array<string>,attributes:struct<paths:array<string>,keys:array<string>,key_value_pairs:array<struct<key:string,value:string>>,query:string,cmd:string,args:array<string>,names:array<string>>>>"


def forensic_artifacts(found: DataFrame, most: int = 20) -> DataFrame:
    """Artifact definitions; what a source shows depends on its type."""
    rows = _parsed(found, _ARTIFACT).filter(_text(F.col("r.name")) != "")
    r, empty = F.col("r"), F.array().cast(STRINGS)
    a = lambda s: s["attributes"]
    shown = lambda s: F.concat(bullets(a(s)["paths"], "- `%s`"), bullets(a(s)["keys"], "- `%s`"), F.coalesce(F.transform(a(s)["key_value_pairs"], lambda p: F.format_string("- Key: `%s`, Value: `%s`", p["key"], p["value"])), empty), bullets(V.scalar_list(a(s)["query"]), "- Query: `%s`"), bullets(V.scalar_list(a(s)["cmd"]), "- Command: `%s`"), bullets(a(s)["names"]))
    parts = F.transform(r["sources"], lambda s, i: F.concat_ws("\n", F.format_string("### Source %d: %s", i + 1, s["type"]), shown(s)))
    body = lines(F.concat(F.lit("# Forensic artifact: "), r["name"]), "", field("Supported OS", F.array_join(r["supported_os"], ", ")), "", section("Description", X.strip(_text(r["doc"]))), section("Sources", F.coalesce(parts, empty)), section("References", bullets(r["urls"])))
    flat = lambda pick: F.slice(F.flatten(F.coalesce(F.transform(r["sources"], lambda s: F.coalesce(pick(s), empty)), F.array().cast("array<array<string>>"))), 1, most)
    meta = F.struct(r["name"].alias("artifact_name"), r["supported_os"].alias("supported_os"), _distinct_sorted(F.coalesce(F.transform(r["sources"], lambda s: s["type"]), empty)).alias("source_types"), flat(lambda s: a(s)["paths"]).alias("file_paths"), flat(lambda s: F.concat(F.coalesce(a(s)["keys"], empty), F.coalesce(F.transform(a(s)["key_value_pairs"], lambda p: p["key"]), empty))).alias("registry_keys"))
    return _document(rows, "forensic_artifacts", "artifact_definition", F.concat(F.lit("forensic-artifact-"), F.lower(r["name"])), F.concat(F.lit("Forensic artifact: "), r["name"]), body, meta)


BLOCK = "(?s)<pre>" + '<code class="language-yaml">' + r"\n?(.*?)" + "</code>" + "</pre>"


def unescaped(c: Column) -> Column:
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def system_of(c: Column) -> Column:
    low = F.lower(c)
    has = lambda *w: F.regexp_like(low, F.lit("|".join(w)))
    return F.when(has("windows"), "Windows").when(has("linux"), "Linux").when(has("mac", "darwin"), "macOS").otherwise("Cross-platform")


def velociraptor(pages: DataFrame) -> DataFrame:
    """Markdown pages (file_path, front_matter, body) with an escaped YAML block, which becomes a fenced one."""
    rows = pages.select(F.col("file_path").alias("source_path"), "front_matter", "body").filter(F.regexp_like("body", F.lit(BLOCK)))
    code = X.strip(unescaped(F.regexp_extract("body", BLOCK, 1)))
    rows = rows.withColumn("code", code)
    value = lambda key: X.strip(F.regexp_extract("code", rf"(?m)^{key}:\s*(.*)$", 1))
    name, kind = value("name"), F.upper(value("type"))
    tags = F.lower("front_matter")
    vql = F.regexp_like("code", F.lit(r"(?i)\b(SELECT|LET)\b"))
    has = lambda t: F.contains(tags, F.lit(t))
    content = (
        F.when((kind == "NOTEBOOK") | has("notebook"), "velociraptor_notebook").when(F.regexp_like("code", F.lit("(?m)^reports:")), "velociraptor_report_template").when(kind.isin("SERVER_EVENT", "CLIENT_EVENT"), "velociraptor_event_artifact").when(kind == "INTERNAL", "velociraptor_internal_artifact")
        .when((kind == "SERVER") | has("server artifact"), "velociraptor_server_artifact").when((kind == "CLIENT") | has("client artifact"), "velociraptor_client_artifact").when(vql, "velociraptor_vql_artifact").otherwise("velociraptor_artifact")
    )
    rows = rows.withColumns({"kind_": content, "name_": F.when(name == "", _stem()).otherwise(name)})
    fenced = X.strip(F.concat(F.regexp_replace(F.substring_index("body", "<pre><code", 1), r"\s+$", ""), F.lit("\n```yaml\n"), F.col("code"), F.lit("\n```\n"), F.regexp_replace("body", r"(?s)\A.*?</code></pre>", "")))
    body = lines(F.concat(F.lit("# "), "name_"), "", field("OS", system_of(F.concat_ws(" ", "name_", F.regexp_extract("code", r"(?m)^precondition:\s*(.*)$", 1)))), "", fenced)
    meta = F.struct(F.col("name_").alias("artifact_name"), kind.alias("artifact_type"), vql.alias("has_vql"), F.col("kind_").alias("kind"))
    out = _document(rows, "velociraptor_artifacts", "velociraptor_artifact", F.concat(F.lit("velociraptor-"), _slug_path()), F.col("name_"), body, meta)
    return out.withColumn("content_type", F.get_json_object("metadata_json", "$.kind"))


_HIJACK = "Name string, Vendor string, CVE string, ExpectedLocations array<string>, VulnerableExecutables array<struct<Path:string,Type:string,Condition:string,Variable:string,SHA256:string,AutoElevate:boolean,PrivilegeEscalation:boolean>>"


def hijacklibs(found: DataFrame) -> DataFrame:
    rows = _parsed(found, _HIJACK)
    r, empty = F.col("r"), F.array().cast(STRINGS)
    flag = lambda name, c: F.when(F.coalesce(c, F.lit(False)), F.lit(f"- **{name}**: yes"))
    exes = F.transform(r["VulnerableExecutables"], lambda x: F.concat_ws("\n", F.concat(F.lit("### `"), _text(x["Path"]), F.lit("`")), F.concat(F.lit("- **Type**: "), x["Type"]), F.concat(F.lit("- **Condition**: "), x["Condition"]), F.concat(F.lit("- **Variable**: "), x["Variable"]), flag("Auto-elevates", x["AutoElevate"]), flag("Raises privileges", x["PrivilegeEscalation"])))
    body = lines(F.concat(F.lit("# DLL hijacking: "), _text(r["Name"])), "", field("Vendor", r["Vendor"]), "", section("Expected locations", bullets(r["ExpectedLocations"], "- `%s`")), section("Vulnerable executables", F.coalesce(exes, empty)))
    pick = lambda k: F.coalesce(F.transform(r["VulnerableExecutables"], lambda x: x[k]), empty)
    meta = F.struct(_text(r["Name"]).alias("dll_name"), _text(r["Vendor"]).alias("vendor"), _distinct_sorted(pick("Type")).alias("hijack_types"), F.size(pick("Path")).alias("vulnerable_exe_count"), V.as_list(pick("Path")).alias("executable_paths"), F.coalesce(r["ExpectedLocations"], empty).alias("expected_locations"), F.array(F.lit("T1574")).alias("mitre_attack_ids"), flexible(r["CVE"]).alias("cves"))
    return _document(rows, "hijacklibs", "dll_hijack_entry", F.concat(F.lit("hijacklib-"), _slug_path()), F.concat(F.lit("DLL hijacking: "), _text(r["Name"])), body, meta)


_DRIVER = "Id string, Tags array<string>, Category string, Created string, MitreID string, CVE string, CVEs string, Resources array<string>, Detection array<struct<type:string,value:string>>, Commands struct<Description:string,Usecase:string,Privileges:string,OperatingSystem:string>, KnownVulnerableSamples array<struct<Filename:string,OriginalFilename:string,InternalName:string,SHA256:string,SHA1:string,MD5:string,Publisher:string,Company:string,Product:string,Description:string,MachineType:string,Imphash:string,LoadsDespiteHVCI:string>>"


def loldrivers(found: DataFrame) -> DataFrame:
    """Drivers by id. A sample is called by its file names, the entry's first tag, or the first 12 digits of a hash."""
    rows = _parsed(found, _DRIVER).filter(_text(F.col("r.Id")) != "")
    r, empty = F.col("r"), F.array().cast(STRINGS)
    nz = lambda c: F.nullif(c, F.lit(""))
    name = lambda s: F.coalesce(nz(s["Filename"]), nz(s["OriginalFilename"]), nz(s["InternalName"]), F.try_element_at(r["Tags"], F.lit(1)), F.substring(nz(s["SHA256"]), 1, 12), F.substring(nz(s["SHA1"]), 1, 12), F.substring(nz(s["MD5"]), 1, 12), F.lit("Unknown"))
    samples = F.transform(r["KnownVulnerableSamples"], lambda s: F.concat_ws("\n", F.concat(F.lit("### "), name(s)), *[F.concat(F.lit(f"- **{k}**: "), nz(s[k])) for k in ("SHA256", "SHA1", "MD5", "Publisher", "Company", "Product", "Description")]))
    cves = F.array_distinct(F.transform(F.concat(flexible(r["CVE"]), flexible(r["CVEs"])), X.strip))
    hashes = F.array_distinct(F.flatten(F.coalesce(F.transform(r["KnownVulnerableSamples"], lambda s: F.array_compact(F.array(*[F.concat(F.lit(f"{k}:"), nz(s[k])) for k in ("SHA256", "SHA1", "MD5")]))), F.array().cast("array<array<string>>"))))
    title = F.concat(F.lit("LOLDriver: "), F.coalesce(F.try_element_at(r["Tags"], F.lit(1)), r["Id"]))
    body = lines(F.concat(F.lit("# "), title), "", field("Category", r["Category"]), field("Technique", r["MitreID"]), field("CVEs", F.array_join(cves, ", ")), "", section("Abuse Details", _text(r["Commands"]["Description"])), section("Samples", F.coalesce(samples, empty)), section("Detection", F.coalesce(F.transform(r["Detection"], lambda d: F.concat(F.lit("- **"), _text(d["type"]), F.lit("**: "), _text(d["value"]))), empty)), section("Resources", bullets(r["Resources"])))
    each = F.transform(r["KnownVulnerableSamples"], lambda s: F.struct(
        name(s).alias("filename"), s["OriginalFilename"].alias("original_filename"), s["InternalName"].alias("internal_name"), s["Product"].alias("product"), s["Company"].alias("company"), s["MachineType"].alias("machine_type"), s["Imphash"].alias("imphash"),
        s["LoadsDespiteHVCI"].alias("loads_despite_hvci"), s["Description"].alias("description"), F.struct(s["MD5"].alias("md5"), s["SHA1"].alias("sha1"), s["SHA256"].alias("sha256")).alias("hashes"),
    ))
    pick = lambda k: F.coalesce(F.transform(r["KnownVulnerableSamples"], lambda s: s[k]), empty)
    meta = F.struct(r["Id"].alias("driver_id"), F.coalesce(r["Tags"], empty).alias("tags"), cves.alias("cves"), hashes.alias("hashes"), _distinct_sorted(F.concat(pick("Publisher"), pick("Company"))).alias("vendors"), _distinct_sorted(pick("Product")).alias("products"), r["Commands"]["Usecase"].alias("usecase"), r["Commands"]["Privileges"].alias("privileges"), r["Commands"]["OperatingSystem"].alias("operating_system"), each.alias("samples"), r["Detection"].alias("detections"))
    return _document(rows, "loldrivers", "vulnerable_driver", F.concat(F.lit("loldriver-"), F.lower(r["Id"])), title, body, meta, V.timestamp(r["Created"]))


_NOTE = "array<struct<category:string,title:string,text:string>>"
CSAF = f"document struct<title:string,category:string,notes:{_NOTE},publisher:struct<name:string>,tracking:struct<id:string,initial_release_date:string,current_release_date:string,version:string>>, vulnerabilities array<struct<cve:string,title:string,notes:{_NOTE},scores:array<struct<cvss_v3:struct<baseScore:double,baseSeverity:string,vectorString:string>,cvss_v2:struct<baseScore:double,baseSeverity:string,vectorString:string>>>,remediations:array<struct<category:string,details:string>>>>"


def advisories(files: DataFrame) -> DataFrame:
    """CSAF advisories (read with the schema CSAF, with their file_path); those without a document are left out."""
    rows = files.withColumnRenamed("file_path", "source_path").filter("document is not null")
    d, empty = F.col("document"), F.array().cast(STRINGS)
    notes = F.transform(d["notes"], lambda n: F.concat_ws("\n", F.concat(F.lit("## "), F.coalesce(F.nullif(n["title"], F.lit("")), n["category"])), n["text"], F.lit("")))

    def score(s: Column) -> Column:
        c = F.coalesce(s["cvss_v3"], s["cvss_v2"])
        return F.concat_ws("\n", F.concat(F.lit("- **CVSS Score**: "), c["baseScore"].cast("string"), F.lit(" ("), _text(c["baseSeverity"]), F.lit(")")), F.concat(F.lit("- **Vector**: `"), c["vectorString"], F.lit("`")))

    summary = lambda v: F.try_element_at(F.filter(v["notes"], lambda n: n["category"] == "summary"), F.lit(1))["text"]
    each = F.transform(F.col("vulnerabilities"), lambda v: F.concat_ws("\n", F.concat(F.lit("### "), F.coalesce(v["cve"], F.lit("Unknown"))), F.concat(F.lit("**Title**: "), v["title"]), F.concat(F.lit("**Summary**: "), summary(v)), F.transform(v["scores"], score), F.when(F.size(v["remediations"]) > 0, F.lit("**Remediations**:")), F.transform(v["remediations"], lambda m: F.concat(F.lit("- **"), _text(m["category"]), F.lit("**: "), _text(m["details"]))), F.lit("")))
    t = d["tracking"]
    body = lines(F.concat(F.lit("# "), F.coalesce(d["title"], F.lit("Untitled"))), "", field("Category", d["category"]), field("Publisher", d["publisher"]["name"]), field("Published", t["initial_release_date"]), field("Last updated", t["current_release_date"]), field("Version", t["version"]), "", F.coalesce(notes, empty), section("Vulnerabilities", F.coalesce(each, empty)))
    area = F.when(F.contains("source_path", F.lit("IT")), "IT").otherwise("OT")
    meta = F.struct(t["id"].alias("advisory_id"), area.alias("area"), F.coalesce(F.transform("vulnerabilities", lambda v: _text(v["cve"])), empty).alias("cve_ids"), F.array_max(F.flatten(F.transform("vulnerabilities", lambda v: F.coalesce(F.transform(v["scores"], lambda s: F.coalesce(s["cvss_v3"], s["cvss_v2"])["baseScore"]), F.array().cast("array<double>"))))).alias("highest_score"))
    return _document(rows, "cisa_advisories", "security_advisory", F.concat(F.lit("cisa-"), F.lower(t["id"])), F.coalesce(d["title"], F.lit("Untitled")), body, meta, V.timestamp(t["initial_release_date"]))


ATLAS = "matrices array<struct<tactics:array<struct<id:string,name:string>>,techniques:array<struct<id:string,name:string,description:string,tactics:array<string>,`subtechnique-of`:string>>,mitigations:array<struct<id:string,name:string,description:string,techniques:array<struct<id:string,use:string>>>>>>, `case-studies` array<struct<id:string,name:string,summary:string,procedure:array<struct<tactic:string,technique:string,description:string>>>>"


def _atlas(found: DataFrame) -> DataFrame:
    return _parsed(found, ATLAS)


def atlas_ids(found: DataFrame) -> DataFrame:
    """Technique ids of all matrices."""
    t = _atlas(found).select(F.explode(F.flatten(F.transform("r.matrices", lambda m: F.transform(m["techniques"], lambda t: t["id"])))).alias("id"))
    return t.filter(F.regexp_like("id", F.lit(r"\AAML\.T\d{4}(\.\d{3})?\z"))).distinct()


def atlas(found: DataFrame) -> DataFrame:
    """Techniques, mitigations and case studies, each with what the others say of it, by peer id or step."""
    rows = _atlas(found)
    matrix = rows.select("source_path", F.explode("r.matrices").alias("m"))
    techniques = matrix.select("source_path", F.explode("m.techniques").alias("t")).select("source_path", "t.*").withColumnRenamed("subtechnique-of", "parent")
    measures = matrix.select("source_path", F.explode("m.mitigations").alias("x")).select("source_path", "x.*")
    cases = rows.select("source_path", F.explode("r.case-studies").alias("c")).select("source_path", "c.*")
    names = F.broadcast(techniques.select(F.col("id").alias("technique"), F.col("name").alias("technique_name")).distinct())  # a matrix has some hundreds of techniques
    line = lambda who, what: F.concat(F.lit("- **"), who, F.lit("**: "), _text(what))
    used = measures.select(F.col("id").alias("peer"), F.col("name").alias("who"), F.explode("techniques").alias("u")).select(F.col("u.id").alias("technique"), "peer", "who", F.col("u.use").alias("what"))
    met = cases.select(F.col("id").alias("peer"), F.col("name").alias("who"), F.posexplode("procedure").alias("step", "p")).select(F.col("p.technique").alias("technique"), "peer", "who", "step", F.col("p.description").alias("what"))
    by = lambda df, key, *order: df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, "line"))).alias("l")).select(key, F.transform("l", lambda x: x["line"]).alias("lines"))
    on = lambda df, key: df.join(key, "id", "left")
    t = on(techniques, by(used.withColumn("line", line(F.col("who"), F.col("what"))), "technique", "peer").select(F.col("technique").alias("id"), F.col("lines").alias("mitigations")))
    t = on(t, by(met.withColumn("line", line(F.col("who"), F.col("what"))), "technique", "peer", "step").select(F.col("technique").alias("id"), F.col("lines").alias("cases")))
    empty = F.array().cast(STRINGS)
    body = lines(F.concat(F.lit("# "), "id", F.lit(": "), "name"), "", field("Tactics", F.array_join(F.coalesce("tactics", empty), ", ")), "", section("Description", _text(F.col("description"))), section("Mitigations", F.coalesce("mitigations", empty)), section("Case studies", F.coalesce("cases", empty)))
    one = _document(t, "mitre_atlas", "atlas_technique", F.concat(F.lit("atlas-"), "id"), F.col("name"), body, F.struct("id", F.coalesce("tactics", empty).alias("tactics"), _text(F.col("parent")).alias("parent_technique")))
    m = on(measures.drop("techniques"), by(used.join(names, "technique", "left").withColumn("line", line(F.coalesce("technique_name", "technique"), F.col("what"))), "peer", "technique").withColumnRenamed("peer", "id"))
    two = _document(m, "mitre_atlas", "atlas_mitigation", F.concat(F.lit("atlas-mit-"), "id"), F.col("name"), lines(F.concat(F.lit("# "), "id", F.lit(": "), "name"), "", section("Description", _text(F.col("description"))), section("Techniques", F.coalesce("lines", empty))), F.struct("id"))
    c = on(cases.drop("procedure"), by(met.join(names, "technique", "left").withColumn("line", line(F.coalesce("technique_name", "technique"), F.col("what"))), "peer", "step").withColumnRenamed("peer", "id"))
    three = _document(c, "mitre_atlas", "atlas_case_study", F.concat(F.lit("atlas-case-"), "id"), F.col("name"), lines(F.concat(F.lit("# "), "id", F.lit(": "), "name"), "", section("Summary", _text(F.col("summary"))), section("Procedure", F.coalesce("lines", empty))), F.struct("id"))
    return one.unionByName(two).unionByName(three)


def skills(pages: DataFrame, least_tokens: int = 500) -> DataFrame:
    """Markdown skills (file_path, front_matter, body) with front matter and at least so many tokens in their body."""
    rows = pages.filter("front_matter <> ''").select(F.col("file_path").alias("source_path"), "front_matter", X.strip(F.col("body")).alias("body"))
    tokens = F.size(F.regexp_extract_all("body", F.lit(r"(\S+)"), F.lit(1)))
    rows = rows.withColumn("body_tokens", tokens).filter(F.col("body_tokens") >= least_tokens)
    value = lambda key: F.regexp_replace(X.strip(F.regexp_extract("front_matter", rf"(?m)^{key}:\s*(.*)$", 1)), "^[\"']|[\"']$", "")
    name = F.coalesce(F.nullif(value("name"), F.lit("")), F.regexp_extract("source_path", r"([^/]*)/[^/]*$", 1))
    headings = lambda word: F.transform(F.regexp_extract_all("body", F.lit(rf"(?m)^#{{2,6}}\s+({word}.*)$"), F.lit(1)), X.strip)
    body = lines(F.concat(F.lit("# Skill: "), name), "", field("Domain", value("domain")), field("Description", value("description")), "", F.col("body"))
    meta = F.struct(name.alias("skill_name"), value("description").alias("description"), value("domain").alias("domain"), value("subdomain").alias("subdomain"), F.array_sort(F.array_distinct(F.regexp_extract_all("front_matter", F.lit(r"\b(T\d{4}" + r"(?:\.\d{3})?)\b"), F.lit(1)))).alias("mitre_attack_ids"), F.length("body").alias("body_chars"), "body_tokens", headings(r"Step\s+\d+").alias("workflow_steps"), headings("Scenario").alias("scenarios"))
    return _document(rows, "cybersec_skills", "practitioner_workflow", F.concat(F.lit("cybersec-skill-"), X.slug(name, "skill")), F.concat(F.lit("Skill: "), name), body, meta)


def volatility_plugins(sources: DataFrame) -> DataFrame:
    """Plugin classes of Python files (file_path, value), found in their syntax trees, with docs, requirements and columns."""
    import ast

    import pandas as pd

    def scan(batches):
        for batch in batches:
            rows = []
            for path, code in zip(batch["file_path"], batch["value"]):
                try:
                    tree = ast.parse(code)
                except (SyntaxError, ValueError):
                    continue
                classes = (c for c in ast.walk(tree) if isinstance(c, ast.ClassDef))
                for node in classes:
                    if not any("PluginInterface" in ast.unparse(b) for b in node.bases):
                        continue
                    calls = [c for c in ast.walk(node) if isinstance(c, ast.Call)]
                    needs = [k.value.value for c in calls if ast.unparse(c.func).endswith("Requirement") for k in c.keywords if k.arg == "name" and isinstance(k.value, ast.Constant)]
                    grids = [c for c in calls if ast.unparse(c.func).endswith("TreeGrid") and c.args and isinstance(c.args[0], (ast.List, ast.Tuple))]
                    columns = [e.elts[0].value for g in grids for e in g.args[0].elts if isinstance(e, ast.Tuple) and e.elts and isinstance(e.elts[0], ast.Constant)]
                    rows.append((path, node.name, ast.get_docstring(node) or "", [str(x) for x in needs], [str(x) for x in columns]))
            yield pd.DataFrame(rows, columns=["source_path", "name", "doc", "needs", "columns"])

    rows = sources.mapInPandas(scan, "source_path string, name string, doc string, needs array<string>, columns array<string>")
    system = F.regexp_extract("source_path", r"/(windows|linux|mac)/", 1)
    title = F.concat_ws(".", F.nullif(system, F.lit("")), F.lower(_stem()), "name")
    body = lines(F.concat(F.lit("# Volatility plugin: "), title), "", field("OS", F.coalesce(F.nullif(system, F.lit("")), F.lit("any"))), "", section("Description", F.col("doc")), section("Requirements", bullets(F.col("needs"))), section("Columns", bullets(F.col("columns"))))
    return _document(rows, "volatility3_docs", "plugin_documentation", F.concat(F.lit("vol3-plugin-"), X.slug(title)), title, body, F.struct(title.alias("plugin"), system.alias("os"), "needs", "columns"))

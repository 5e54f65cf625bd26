"""Registered queries over the test tables, each with the SQL of the same rows.

The process tables are derived from the given ones by the rules in ``inputs``, ``outputs`` and ``metadata`` (and the same
rules in SQL below); every query runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import Catalog
from .functions import dates as D
from .functions import paths as P
from .functions import pii
from .functions.replace import replace_strings
from .operators import match, ner, ocr, queues
from .operators.upsert import upsert_pairs
from .plans.stages import placeholders, registrations, rewritten, transcript_path
from .sources.files import list_files, read_each, write_texts
from .sources.lists import keyed_values, read_list
from .sources.store import fresh_folder

AS_OF = datetime(2002, 1, 1)
DAYS = 3
CHAIN = ("the", "ein", "La")
MANY = ("Apache License", "stupid", "worthless", "MIT License.", "&&&", "$$$", "###")
LABEL_CYCLE = ("PATIENT", "STAFF", "HOSPITAL", "O", "ID", "DATE", "VENDOR", "XYZ")
Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, ("document", "page", "block"))), (F.col("doc_id") % 3 + 1).cast("int"))
    folder = F.when(F.col("doc_id") % 7 == 0, "misc").otherwise(F.concat(F.lit("094-"), F.lpad((F.col("doc_id") % 1_000_000).cast("string"), 6, "0")))
    end = F.when(F.col("doc_id") % 5 == 0, ".PDF").when(F.col("doc_id") % 5 == 1, ".txt").otherwise(".pdf")
    path = F.concat(F.lit("/study/"), folder, F.lit("/scan_"), F.col("doc_id"), end)
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), kind.alias("document_type"), path.alias("input_file"))


def outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    return table(spark, sf_dir, "labels").select(
        (d * 10).alias("id"),
        d.alias("input_id"),
        F.when(d % 4 != 0, F.concat(F.lit("/out/unstructured_text/t"), d, F.lit("-1-1.txt"))).alias("ocr_output_file"),
        (d % 101).cast("double").alias("ocr_confidence"),
        F.when(d % 3 == 1, "").when(d % 3 == 2, F.concat(F.lit("/out/list_replacement_output_file/t"), d, F.lit(".txt"))).alias("list_replacement_output_file"),
        F.when((d % 5 == 0) & (F.col("quality") == 1), F.concat(F.lit("/out/pii/t"), d, F.lit(".txt"))).alias("pii_scrubber_output_file"),
        F.when(d % 5 == 0, F.concat(F.lit("/out/pii/confidence-t"), d, F.lit(".json"))).alias("pii_scrubber_confidence_file"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("input_id"),
        F.concat(F.lit("094-"), F.lpad(F.col("o_custkey").cast("string"), 6, "0")).alias("subject_id"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("visit_date"),
    )


INPUTS = """inputs as (select doc_id id, case doc_id % 3 when 0 then 'document' when 1 then 'page' else 'block' end document_type,
  '/study/' || case when doc_id % 7 = 0 then 'misc' else '094-' || lpad((doc_id % 1000000)::varchar, 6, '0') end || '/scan_' || doc_id
  || case doc_id % 5 when 0 then '.PDF' when 1 then '.txt' else '.pdf' end input_file from documents)"""
OUTPUTS = """outputs as (select doc_id * 10 id, doc_id input_id,
  case when doc_id % 4 <> 0 then '/out/unstructured_text/t' || doc_id || '-1-1.txt' end ocr_output_file, (doc_id % 101)::double ocr_confidence,
  case doc_id % 3 when 1 then '' when 2 then '/out/list_replacement_output_file/t' || doc_id || '.txt' end list_replacement_output_file,
  case when doc_id % 5 = 0 and quality = 1 then '/out/pii/t' || doc_id || '.txt' end pii_scrubber_output_file,
  case when doc_id % 5 = 0 then '/out/pii/confidence-t' || doc_id || '.json' end pii_scrubber_confidence_file from labels)"""
METADATA = """metadata as (select o_orderkey id, o_custkey input_id, '094-' || lpad(o_custkey::varchar, 6, '0') subject_id,
  case when o_orderstatus <> 'O' then o_orderdate end visit_date from orders)"""
VISITS = """v as (select distinct o_custkey k, o_orderdate v from orders),
  e as (select o_custkey k, l_shipdate e, l_orderkey a, l_linenumber b from lineitem join orders on l_orderkey = o_orderkey)"""
FIRST = f"""{VISITS}, r as (select k, v, e, row_number() over (partition by k, v order by a, b, e) rn
  from v join e using (k) where e between v - interval {DAYS} day and v + interval {DAYS} day)"""
LINES = """l as (select doc_id, unnest(case when p[-1] = '' then p[:-2] else p end) line, unnest(range(len(case when p[-1] = '' then p[:-2] else p end))) n
  from (select doc_id, string_split_regex(text, '\\r\\n|\\r|\\n') p from documents))"""

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return keep


def _visits(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderdate").alias("visit"))


def _extracted(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select("key", F.col("l_shipdate").alias("extracted"), "l_orderkey", "l_linenumber")


@query("band_first_match", f"with {FIRST} select k as key, v as visit, e as extracted from r where rn = 1")
def band_first_match(spark, sf_dir):
    return match.first_match(_extracted(spark, sf_dir), _visits(spark, sf_dir), DAYS, ["l_orderkey", "l_linenumber", "extracted"])


@query("band_all_pairs", f"with {FIRST} select k as key, v as visit, e as extracted from r")
def band_all_pairs(spark, sf_dir):
    return match.band_join(_extracted(spark, sf_dir).select("key", "extracted"), _visits(spark, sf_dir).distinct(), DAYS).select("key", "visit", "extracted")


@query(
    "profile_bounds",
    """with f as (select o_custkey k, arg_min(o_orderdate, o_orderkey) filter (where o_orderstatus = 'O') birth,
      arg_min(o_orderdate, o_orderkey) filter (where o_orderstatus = 'F') death from orders group by 1)
    select c_custkey, coalesce(birth, timestamp '2010-01-01') as earliest, coalesce(death, timestamp '2002-01-01') as latest from customer left join f on c_custkey = k""",
)
def profile_bounds(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rows = o.select("o_custkey", "o_orderkey", *[F.when(F.col("o_orderstatus") == s, F.col("o_orderdate")).alias(n) for s, n in (("O", "birth"), ("F", "death"))])
    first = match.first_dates(rows, "o_custkey", "o_orderkey", ["birth", "death"])
    ntz = lambda d: F.lit(d).cast("timestamp_ntz")
    joined = table(spark, sf_dir, "customer").join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", F.coalesce("birth", ntz(D.EARLIEST)).alias("earliest"), F.coalesce("death", ntz(AS_OF)).alias("latest"))


@query(
    "id_priority_lookup",
    """select c_custkey as id, o_orderkey as pos, o_orderdate as value from customer join orders
    on o_custkey = c_custkey or (o_orderkey % 5000 = c_custkey and o_custkey <> c_custkey)""",
)
def id_priority_lookup(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("grls_id"), (F.col("o_orderkey") % 5000).alias("subject_id"), "o_orderdate", "o_orderkey")
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return keyed_values(rows, ids, "o_orderdate", position=F.col("o_orderkey"))


@query("subject_extract", f"with {INPUTS} select id, regexp_extract(input_file, '094-[0-9]{{6}}') as subject_id from inputs where regexp_matches(input_file, '094-[0-9]{{6}}')")
def subject_extract(spark, sf_dir):
    subject = P.subject_id(P.dirname(F.col("input_file")))
    return inputs(spark, sf_dir).select("id", subject.alias("subject_id")).where("subject_id is not null")


@query(
    "register_pairs",
    f"""with {INPUTS} select input_file, 'document' as document_type, timestamp '2002-01-01' as created, regexp_extract(input_file, '094-[0-9]{{6}}') as subject_id
    from inputs where regexp_matches(input_file, '094-[0-9]{{6}}')""",
)
def register_pairs(spark, sf_dir):
    files = inputs(spark, sf_dir).select(F.col("input_file").alias("path"), P.dirname(F.col("input_file")).alias("directory"))
    return registrations(files, "document", AS_OF)


@query(
    "ocr_queue",
    f"""with {INPUTS}, {OUTPUTS} select i.id, i.input_file, coalesce(o.id, -1) as output_id from inputs i left join outputs o on o.input_id = i.id
    where i.input_file ilike '%.pdf' and i.document_type = 'document' and o.ocr_output_file is null""",
)
def ocr_queue(spark, sf_dir):
    return queues.ocr_queue(inputs(spark, sf_dir), outputs(spark, sf_dir), "document").fillna(-1, ["output_id"])


_READY = """select o.id, o.input_id, i.input_file, o.ocr_output_file, coalesce(nullif(o.list_replacement_output_file, ''), o.ocr_output_file) as text_file
    from inputs i join outputs o on o.input_id = i.id where i.document_type = 'page' and o.ocr_output_file is not null"""


@query("replace_queue", f"with {INPUTS}, {OUTPUTS} {_READY}")
def replace_queue(spark, sf_dir):
    return queues.replace_queue(inputs(spark, sf_dir), outputs(spark, sf_dir), "page")


@query("scrub_queue", f"with {INPUTS}, {OUTPUTS} {_READY} and o.pii_scrubber_output_file is null")
def scrub_queue(spark, sf_dir):
    return queues.scrub_queue(inputs(spark, sf_dir), outputs(spark, sf_dir), "page")


@query(
    "mine_queue",
    f"""with {OUTPUTS}, {METADATA} select o.id, o.input_id, m.subject_id, o.ocr_output_file, o.pii_scrubber_confidence_file
    from outputs o left join metadata m on m.input_id = o.input_id where m.visit_date is null""",
)
def mine_queue(spark, sf_dir):
    return queues.mine_queue(outputs(spark, sf_dir), metadata(spark, sf_dir))


@query("page_window", f"with {INPUTS} select id, document_type, input_file from inputs order by id limit 50 offset 100")
def page_window(spark, sf_dir):
    return queues.page(inputs(spark, sf_dir), 50, 100)


def _pages(spark, sf_dir):
    """Each line of a document as a page with a made-up confidence."""
    each = D.lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return each.select(F.col("doc_id").alias("id"), F.col("text").alias("content"), (F.length("text") % 101).cast("double").alias("confidence"), (F.col("line") + 1).alias("page"))


@query(
    "ocr_doc_rollup",
    f"""with {LINES} select doc_id as id, string_agg(chr(10) || line, '' order by n) as content, avg((length(line) % 101)::double) as confidence, 1 as page, 1 as block
    from l where length(line) > 0 and length(line) % 101 > 0 group by 1""",
)
def ocr_doc_rollup(spark, sf_dir):
    return ocr.document_rollup(_pages(spark, sf_dir))


@query("ocr_page", f"with {LINES} select doc_id as id, line as content, (length(line) % 101)::double as confidence, (n + 1)::int as page, 0 as block from l")
def ocr_page(spark, sf_dir):
    return ocr.page_results(_pages(spark, sf_dir))


@query("ocr_block", f"with {LINES} select doc_id as id, line as content, (length(line) % 101)::double as confidence, 1 as page, (n + 1)::int as block from l")
def ocr_block(spark, sf_dir):
    each = _pages(spark, sf_dir).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("page", "content", "confidence"))).alias("lines"))
    return ocr.block_results(each.withColumn("page", F.lit(1)))


@query(
    "last_result",
    f"""with {LINES} select doc_id as id, arg_max(line, n) as content, (length(arg_max(line, n)) % 101)::double as confidence, (max(n) + 1)::int as page, 0 as block from l group by 1""",
)
def last_result(spark, sf_dir):
    return ocr.last_result(ocr.page_results(_pages(spark, sf_dir)))


@query("low_confidence", f"with {LINES} select floor((length(line) % 101) / 10.0)::int as bin, count(*) as n, count(*) filter (where length(line) % 101 < 60) as n_low from l group by 1")
def low_confidence(spark, sf_dir):
    return ocr.confidence_metrics(_pages(spark, sf_dir), 60)


def _literal(target: str) -> str:
    return "".join("\\" + c if c in ".$&#()[]{}+*?^|\\" else c for c in target)


def _replaced(targets, new: str) -> str:
    out = "text"
    for t in targets:
        out = f"regexp_replace({out}, '{_literal(t)}', '{new}', 'gi')"
    return f"select doc_id, md5({out}) as digest from documents"


def _replace(targets, new):
    def run(spark, sf_dir):
        return table(spark, sf_dir, "documents").select("doc_id", F.md5(replace_strings(F.col("text"), targets, new).cast("binary")).alias("digest"))

    return run


query("replace_literal", _replaced(CHAIN[:1], "$1"))(_replace([None, "", "  ", *CHAIN[:1]], "$1"))
query("replace_deleted", _replaced(CHAIN, ""))(_replace(CHAIN, ""))
query("replace_folded", _replaced(("É", "Ü", "ñ"), "<L>"))(_replace(("É", "Ü", "ñ"), "<L>"))


@query("replace_blank_kept", "select p_partkey, case when p_name = '' then '|' else '|' || array_to_string(string_split(p_name, ''), '|') || '|' end as name from part")
def replace_blank_kept(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", replace_strings(F.col("p_name"), [""], "|", keep_blank=True).alias("name"))


@query("replace_quoted", f"select p_partkey, regexp_replace(regexp_replace(p_name || '\\E.a\\Q\\e', '{_literal(chr(92) + 'E.A' + chr(92) + 'Q')}', '_', 'gi'), '{_literal(chr(92) + 'E')}', '_', 'gi') as name from part")
def replace_quoted(spark, sf_dir):
    """Targets that hold the marks by which patterns are quoted."""
    text = F.concat("p_name", F.lit("\\E.a\\Q\\e"))
    return table(spark, sf_dir, "part").select("p_partkey", replace_strings(text, ["\\E.A\\Q", "\\E"], "_").alias("name"))


query("replace_one", _replaced(CHAIN[:1], "<ID>"))(_replace(CHAIN[:1], "<ID>"))
query("replace_chain", _replaced(CHAIN, "<ID>"))(_replace(CHAIN, "<ID>"))
query("replace_many", _replaced(MANY, "[removed]"))(_replace(MANY, "[removed]"))


@query("coalesce_input", f"with {OUTPUTS} select id, coalesce(nullif(list_replacement_output_file, ''), nullif(ocr_output_file, '')) as text_file from outputs")
def coalesce_input(spark, sf_dir):
    return outputs(spark, sf_dir).select("id", P.text_input(F.col("list_replacement_output_file"), F.col("ocr_output_file")).alias("text_file"))


@query(
    "stem",
    f"""with {INPUTS} select id, regexp_replace(regexp_extract(input_file, '[^/]*$'), '([^.])\\.[^.]*$', '\\1') as stem, regexp_extract(input_file, '\\.[^.]*$') as extension,
    '/out/list_replacement_output_file/' || document_type || '/' || regexp_replace(regexp_extract(input_file, '[^/]*$'), '([^.])\\.[^.]*$', '\\1') || '.txt' as path from inputs""",
)
def stem(spark, sf_dir):
    name = P.stem(F.col("input_file"))
    path = P.output_path("/out/", "list_replacement_output_file", F.col("document_type"), F.concat(name, F.lit(".txt")))
    return inputs(spark, sf_dir).select("id", name.alias("stem"), P.extension(F.col("input_file")).alias("extension"), path.alias("path"))


def _checks(m: str) -> dict[str | None, str]:
    """SQL of the recognisers' checks of the match ``m``."""
    digits = f"reverse(regexp_replace({m}, '[^0-9]', '', 'g'))"
    letters = "'0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
    return {
        None: "true",
        "octets": f"list_bool_and(list_transform(string_split({m}, '.'), lambda p: p::int <= 255))",
        "luhn": f"list_sum(list_transform(range(len({digits})), lambda i: case when i % 2 = 0 then ({digits}[i + 1])::int "
        f"else ({digits}[i + 1])::int * 2 - case when ({digits}[i + 1])::int > 4 then 9 else 0 end end)) % 10 = 0",
        "ssn": f"substr({m}, 1, 3) not in ('000', '666') and substr({m}, 1, 3) < '900' and substr({m}, 5, 2) <> '00' and substr({m}, 8, 4) <> '0000'",
        "iban": f"list_reduce([0] || list_transform(string_split(substr({m}, 5) || substr({m}, 1, 4), ''), lambda c: (instr({letters}, c) - 1)::int), lambda a, v: (a * case when v > 9 then 100 else 10 end + v) % 97) = 1",
    }


def _found(recognisers) -> str:
    """SQL of (doc_id, entity, score, m) for every match that its check accepts."""
    checks = _checks("m")
    return " union all ".join(f"select doc_id, '{e}' entity, {s}::double score, m from (select doc_id, unnest(regexp_extract_all(text, '{p}')) m from documents) where {checks[c]}" for e, p, s, c in recognisers)


def _detected(spark, sf_dir, threshold=0.0):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.withColumn("spans", pii.keep_spans(pii.detect(F.col("text")), threshold))


@query("pii_detect", f"select doc_id, entity, count(*) as n, sum(length(m))::bigint as length from ({_found(pii.RECOGNISERS)}) group by all")
def pii_detect(spark, sf_dir):
    each = _detected(spark, sf_dir).select("doc_id", F.explode("spans").alias("s"))
    return each.groupBy("doc_id", F.col("s.entity").alias("entity")).agg(F.count("*").alias("n"), F.sum(F.col("s.end") - F.col("s.start")).alias("length"))


@query("pii_threshold", f"select doc_id, entity, score, count(*) as n from ({_found(pii.RECOGNISERS)}) where score >= 0.75 group by all")
def pii_threshold(spark, sf_dir):
    each = _detected(spark, sf_dir, 0.75).select("doc_id", F.explode("spans").alias("s"))
    return each.groupBy("doc_id", F.col("s.entity").alias("entity"), F.col("s.score").alias("score")).agg(F.count("*").alias("n"))


@query("pii_record", f"select doc_id, replace(m, chr(10), '') as original, entity as type, score from ({_found(pii.RECOGNISERS)})")
def pii_record(spark, sf_dir):
    docs = _detected(spark, sf_dir)
    each = docs.select("doc_id", F.explode(pii.record(F.col("text"), F.col("spans"))).alias("r"))
    return each.select("doc_id", F.col("r.Original Text").alias("original"), F.col("r.Type").alias("type"), F.col("r.Score").alias("score"))


def _scrubbed(text: str, source: str) -> str:
    """SQL of (doc_id, new): ``text`` of ``source`` with all recognisers' spans found, checked, resolved and replaced."""
    size = lambda x: f"coalesce(list_sum(list_transform({x}, lambda x: length(x))), 0)"
    checks = _checks("s.m")
    found = []
    for e, p, score, c in pii.RECOGNISERS:
        m, g = f"regexp_extract_all(x, '{p}')", f"string_split_regex(x, '{p}')"
        start = f"({size('g[1:i]')} + {size('m[1:i - 1]')})::int"
        spans = f"list_transform(range(1, len(m) + 1), lambda i: {{'start': {start}, 'end': {start} + length(m[i])::int, 'entity': '{e}', 'score': {score}::double, 'm': m[i]}})"
        found.append(f"select doc_id, x, list_filter({spans}, lambda s: {checks[c]}) spans from (select doc_id, x, {m} m, {g} g from t) where len(m) > 0")
    return f"""t as (select doc_id, {text} x from {source}), found as ({" union all ".join(found)}),
    every as (select doc_id, any_value(x) x, list_sort(flatten(list(spans))) spans from found group by 1 having len(flatten(list(spans))) > 0),
    kept as (select doc_id, x, list_reduce(list_transform(spans, lambda s: [s]), lambda acc, s: case when s[1].start >= acc[-1]."end" then list_concat(acc, s)
      when s[1].score > acc[-1].score or (s[1].score = acc[-1].score and s[1]."end" - s[1].start > acc[-1]."end" - acc[-1].start) then list_concat(acc[:-2], s) else acc end) k from every),
    scrubbed as (select doc_id, array_to_string(list_transform(range(1, len(k) + 1), lambda i: substr(x, case when i = 1 then 0 else k[i - 1]."end" end + 1, k[i].start - case when i = 1 then 0 else k[i - 1]."end" end)
      || '<' || k[i].entity || '>'), '') || substr(x, k[-1]."end" + 1) y from kept),
    changed as (select t.doc_id, coalesce(y, x) as new from t left join scrubbed on scrubbed.doc_id = t.doc_id)"""


_DENSE = "text || ' 094-123456-7890-1234@mail.org http://10.20.30.40/2001-02-03?c=4111111111111111 by 999.1.1.1, 4111 1111 1111 1112; 536-90-4399, 000-12-3456, 555-123-4567, GB82WEST12345698765432 and GB83WEST12345698765432'"


@query("pii_redact", f"with {_scrubbed('text', 'documents')} select doc_id, md5(new) as digest from changed")
def pii_redact(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", pii.scrub(F.col("text"))[0].alias("new"))
    return docs.select("doc_id", F.md5(F.col("new").cast("binary")).alias("digest"))


@query("pii_redact_overlaps", f"with {_scrubbed(_DENSE, 'documents')} select doc_id, md5(new) as digest from changed")
def pii_redact_overlaps(spark, sf_dir):
    """Each text with a line in which matches overlap and checks refuse some."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr(_DENSE).alias("text"))
    return docs.select("doc_id", F.md5(pii.scrub(F.col("text"))[0].cast("binary")).alias("digest"))


PAN = ("IN_PAN", "[A-Z]{5}[0-9]{4}[A-Z]", 0.95, None)


@query("pii_excluded", "select p_partkey, 'EMAIL_ADDRESS' as entity, 15 as start from part")
def pii_excluded(spark, sf_dir):
    text = F.concat(F.lit("Pan ABCDE"), F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0"), F.lit("F p"), F.col("p_partkey"), F.lit("@x.org"))
    spans = pii.keep_spans(pii.detect(text, [*pii.RECOGNISERS, PAN]))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(spans).alias("s")).select("p_partkey", F.col("s.entity").alias("entity"), F.col("s.start").alias("start"))


@query(
    "label_map",
    """with x as (select doc_id, case doc_id % 8 when 0 then 'PERSON' when 1 then 'PERSON' when 2 then 'LOCATION' when 3 then null when 4 then 'ID'
      when 5 then 'DATE_TIME' when 6 then 'ORGANIZATION' else 'XYZ' end entity from documents)
    select doc_id, entity, case when entity = 'ID' then 0.9::double * 0.4::double else 0.9::double end as score from x""",
)
def label_map(spark, sf_dir):
    label = F.element_at(F.array(*map(F.lit, LABEL_CYCLE)), (F.col("doc_id") % 8 + 1).cast("int"))
    rows = table(spark, sf_dir, "documents").select("doc_id", pii.map_label(label).alias("entity"))
    return rows.withColumn("score", pii.scaled_score(F.col("entity"), F.lit(0.9)))


def _notes(spark, sf_dir):
    """A note of two lines, the second without a date, for each order."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("Visit on "), day, F.lit(" noted\r\nno further remark\n")).alias("text"))


@query("line_dates", "select o_orderkey, 0 as line, date_trunc('day', o_orderdate)::timestamp as date from orders")
def line_dates(spark, sf_dir):
    return D.line_dates(_notes(spark, sf_dir), AS_OF)


@query("line_dates_strict", "select o_orderkey, 0 as line, date_trunc('day', o_orderdate)::timestamp as date from orders")
def line_dates_strict(spark, sf_dir):
    return D.line_dates(_notes(spark, sf_dir), AS_OF, strict=True)


@query("json_dates", "select o_orderkey, unnest([0, 1])::int as pos, unnest([o_orderdate::date, o_orderdate::date + 1])::timestamp as date from orders")
def json_dates(spark, sf_dir):
    day = lambda n: F.date_format(F.date_add("o_orderdate", n), "yyyy-MM-dd")
    text = F.concat(F.lit('[{"Original Text": "'), day(0), F.lit('", "Start": 3}, {"a": ["none", {"b": "'), day(1), F.lit('"}]}]'))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    return D.json_dates(rows, AS_OF).select("o_orderkey", F.posexplode("dates").alias("pos", "date"))


@query(
    "date_bounds",
    """select l_orderkey, l_linenumber, l_shipdate from lineitem join orders on l_orderkey = o_orderkey where l_shipdate between
    o_orderdate + interval 10 day and coalesce(case when o_orderstatus = 'F' then o_orderdate + interval 60 day end, timestamp '2002-01-01')""",
)
def date_bounds(spark, sf_dir):
    o, line = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    low = F.col("o_orderdate") + F.expr("interval 10 days")
    high = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("interval 60 days"))
    joined = line.join(o, line["l_orderkey"] == o["o_orderkey"])
    return joined.where(D.within(F.col("l_shipdate"), low, high, AS_OF)).select("l_orderkey", "l_linenumber", "l_shipdate")


@query("date_dedup", "select o_custkey as key, l_shipdate as date, min(l_orderkey * 10 + l_linenumber) as pos from lineitem join orders on l_orderkey = o_orderkey group by 1, 2")
def date_dedup(spark, sf_dir):
    rows = _extracted(spark, sf_dir).select("key", F.col("extracted").alias("date"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"))
    return D.distinct_dates(rows, ["key"])


@query(
    "upsert_pairs",
    f"""with {FIRST}, p as (select k, v, e from r where rn = 1), low as (select k, v, e from p qualify row_number() over (partition by k order by v, e) = 1)
    select c_custkey as input_id, low.v as visit_date, low.e as extracted_date from customer left join low on low.k = c_custkey
    union all select k, v, e from p where not exists (select 1 from low join customer on c_custkey = low.k where low.k = p.k and low.v = p.v and low.e = p.e)""",
)
def upserted(spark, sf_dir):
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("year_in_study", "int"), ("visit_date", "timestamp_ntz"), ("extracted_date", "timestamp_ntz"))]
    subject = lambda c: F.concat(F.lit("094-"), F.lpad(F.col(c).cast("string"), 6, "0"))
    holders = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("input_id"), subject("c_custkey").alias("subject_id"), *nothing)
    pairs = band_first_match(spark, sf_dir).select(subject("key").alias("subject_id"), F.col("key").alias("input_id"), F.col("visit").alias("visit_date"), F.col("extracted").alias("extracted_date"))
    return upsert_pairs(holders, pairs).select("input_id", "visit_date", "extracted_date")


@query("pair_in", f"with {FIRST} select k as key, v as visit, e as extracted from r where rn = 1 and (k, e) in (select k, v from v)")
def pair_in(spark, sf_dir):
    return match.pairs_in(band_first_match(spark, sf_dir), _visits(spark, sf_dir).select("key", F.col("visit").alias("extracted")), ["key", "extracted"])


@query("pair_not_in", f"with {FIRST} select k as key, v as visit, e as extracted from r where rn = 1 and (k, e) not in (select k, v from v)")
def pair_not_in(spark, sf_dir):
    found = match.pairs_not_in(band_first_match(spark, sf_dir), _visits(spark, sf_dir).select("key", F.col("visit").alias("extracted")), ["key", "extracted"])
    return found.select("key", "visit", "extracted")


@query("dates_default_bounds", "select event_id, 0 as line, date_trunc('day', ts)::timestamp as date from events where date_trunc('day', ts) <= timestamp '2024-01-15'")
def dates_default_bounds(spark, sf_dir):
    """Dates of 2024 within the bounds that hold without a profile: from 2010 to ``as_of``, both inclusive."""
    as_of = datetime(2024, 1, 15)
    texts = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("Seen on "), F.date_format("ts", "yyyy-MM-dd"), F.lit("; no more")).alias("text"))
    return D.line_dates(texts, as_of).where(D.within(F.col("date"), None, None, as_of))


@query("dates_filled", "select o_orderkey, 0 as line, last_day(make_date(2001, month(o_orderdate)::int, 1))::timestamp as date from orders")
def dates_filled(spark, sf_dir):
    """A month's name only: year and day come from ``as_of``, the day held at the month's last."""
    texts = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("seen in "), F.date_format("o_orderdate", "MMMM")).alias("text"))
    return D.line_dates(texts, datetime(2001, 1, 31, 14, 5))


@query("dates_refused", "select o_orderkey, 1 as line, date_trunc('day', o_orderdate)::timestamp as date from orders")
def dates_refused(spark, sf_dir):
    """Two dates in one line give none; one in the next line is found."""
    day = lambda n: F.date_format(F.date_add("o_orderdate", n), "M/d/yyyy")
    texts = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("Visit on "), day(0), F.lit(" and "), day(5), F.lit("\nthen "), day(0)).alias("text"))
    return D.line_dates(texts, AS_OF)


@query(
    "dates_us_order",
    """select o_orderkey, unnest([0, 1])::int as line, unnest([o_orderdate::date, case when day(o_orderdate) > 12 then o_orderdate::date
      else make_date(year(o_orderdate)::int, day(o_orderdate)::int, month(o_orderdate)::int) end])::timestamp as date from orders""",
)
def dates_us_order(spark, sf_dir):
    """Month first where that can be, else day first; years of two digits."""
    texts = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.date_format("o_orderdate", "MM/dd/yy"), F.lit("\n"), F.date_format("o_orderdate", "dd/MM/yyyy")).alias("text"))
    return D.line_dates(texts, AS_OF)


def _files(spark, sf_dir):
    """A file for each order by its key: JSON, text, one of another type, and one without a path."""
    key, day = F.col("o_orderkey"), lambda n: F.date_format(F.date_add("o_orderdate", n), "yyyy-MM-dd")
    tree = F.concat(F.lit('{"a": {"b": ["seen '), day(0), F.lit('", 7, "none"]}, "c": "'), day(1), F.lit('"}'))
    path = F.when(key % 4 == 0, F.concat(F.lit("/x/"), key, F.lit(".json"))).when(key % 4 == 1, F.concat(F.lit("/x/"), key, F.lit(".txt"))).when(key % 4 == 2, F.concat(F.lit("/x/"), key, F.lit(".doc")))
    text = F.when(key % 4 == 0, tree).otherwise(F.concat(F.lit("a remark\n\nseen "), day(0), F.lit("\r"), day(1)))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", path.alias("path"), text.alias("text"))


_FILE_DATES = """fd as (select o_orderkey, o_custkey, '/x/' || o_orderkey || case o_orderkey % 4 when 0 then '.json' else '.txt' end path,
    unnest(case o_orderkey % 4 when 0 then [0, 1] else [2, 3] end)::int pos, unnest([o_orderdate::date, o_orderdate::date + 1])::timestamp date from orders where o_orderkey % 4 < 2)"""


@query("dates_by_file_type", f"with {_FILE_DATES} select o_orderkey, path, pos, date from fd")
def dates_by_file_type(spark, sf_dir):
    return D.file_dates(_files(spark, sf_dir).drop("o_custkey"), AS_OF)


@query("dates_in_file_order", f"with {_FILE_DATES} select o_custkey, arg_min(date, (case when ends_with(path, '.json') then 0 else 1 end, o_orderkey, pos)) as date from fd group by 1")
def dates_in_file_order(spark, sf_dir):
    """Each customer's first date over several files: records before texts, then by file and place."""
    found = D.file_dates(_files(spark, sf_dir), AS_OF).withColumn("rank", F.when(F.col("path").endswith(".json"), 0).otherwise(1))
    return found.groupBy("o_custkey").agg(F.min_by("date", F.struct("rank", "o_orderkey", "pos")).alias("date"))


@query(
    "cell_dates",
    """select c_custkey as id, o_orderkey as pos, (o_orderdate::date + interval 15 year)::timestamp as date from customer join orders
    on o_custkey = c_custkey or (o_orderkey % 5000 = c_custkey and o_custkey <> c_custkey)
    where o_orderdate::date + interval 15 year between timestamp '2010-01-01' and timestamp '2014-06-01'""",
)
def cell_dates(spark, sf_dir):
    """Dates of looked-up list cells within the default bounds."""
    day = F.date_format(F.col("o_orderdate").cast("date") + F.expr("interval 15 years"), "yyyy-MM-dd")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("grls_id"), (F.col("o_orderkey") % 5000).alias("subject_id"), day.alias("day"), "o_orderkey")
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return D.cell_dates(keyed_values(rows, ids, "day", position=F.col("o_orderkey")), datetime(2014, 6, 1))


def _texts_of(queue: DataFrame, spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_doc"), "text")
    return queue.join(docs, queue["input_id"] == docs["_doc"]).drop("_doc")


_FOLDER = "coalesce(nullif(regexp_extract(input_file, '094-[0-9]{6}'), ''), 'none')"


@query(
    "replaced_texts",
    f"""with {INPUTS}, {OUTPUTS}, q as ({_READY}) select q.id, '/new/list_replacement_output_file/page/' || {_FOLDER} || '/t' || input_id || '-1-1.txt' as path,
    md5(regexp_replace(text, 'the', '[x]', 'gi')) as digest from q join documents on doc_id = input_id""",
)
def replaced_texts(spark, sf_dir):
    """What the replace stage writes, and where."""
    rows = _texts_of(queues.replace_queue(inputs(spark, sf_dir), outputs(spark, sf_dir), "page"), spark, sf_dir)
    out = rewritten(rows, "/new", "list_replacement_output_file", "page", lambda t: replace_strings(t, ["the"], "[x]"))
    return out.select("id", "path", F.md5(F.col("new").cast("binary")).alias("digest"))


@query(
    "scrubbed_texts",
    f"""with {INPUTS}, {OUTPUTS}, q as ({_READY} and o.pii_scrubber_output_file is null), {_scrubbed("text", "documents")}
    select q.id, '/new/pii_scrubber_output_file/page/' || {_FOLDER} || '/t' || input_id || '-1-1.txt' as path, md5(new) as digest,
    '/new/pii_scrubber_confidence_file/page/' || {_FOLDER} || '/confidence-t' || input_id || '-1-1.json' as record_path,
    coalesce(len(e.spans), 0)::int as n from q join changed on changed.doc_id = input_id left join every e on e.doc_id = input_id""",
)
def scrubbed_texts(spark, sf_dir):
    """What the scrub stage writes, and where; how many entries the confidence records have."""
    rows = _texts_of(queues.scrub_queue(inputs(spark, sf_dir), outputs(spark, sf_dir), "page"), spark, sf_dir)
    out = rewritten(rows, "/new", "pii_scrubber_output_file", "page", lambda t: pii.scrub(t)[0], lambda t: pii.scrub(t)[1])
    return out.select("id", "path", F.md5(F.col("new").cast("binary")).alias("digest"), "record_path", F.json_array_length("record").alias("n"))


@query("transcript_paths", f"with {INPUTS}, {LINES} select id, (n + 1)::int as page, '/new/unstructured_text/page/' || {_FOLDER} || '/scan_' || id || '-' || (n + 1) || '-0.txt' as path from l join inputs on id = doc_id")
def transcript_paths(spark, sf_dir):
    """Where the transcribe stage writes each page."""
    pages = ocr.page_results(_pages(spark, sf_dir)).join(inputs(spark, sf_dir).select("id", "input_file"), "id")
    return pages.select("id", "page", transcript_path("/new", "page").alias("path"))


class PathReader(ocr.OcrEngine):
    """Two pages made up from a path, of one with digits only in even places; texts can't be read."""

    def results(self, path: str, document_type: str):
        if path.endswith(".txt"):
            raise ValueError("not a scan")
        for page in (1, 2):
            yield {"content": f"{path} {page}", "confidence": float(len(path) % 101), "page": page, "block": 0}


@query(
    "ocr_engine",
    f"""with {INPUTS} select id, input_file || ' ' || page as content, (length(input_file) % 101)::double as confidence, page::int as page, 0 as block, null::varchar as error
    from inputs, (select unnest([1, 2]) page) where not ends_with(input_file, '.txt') union all select id, null, null, null, null, 'not a scan' from inputs where ends_with(input_file, '.txt')""",
)
def ocr_engine(spark, sf_dir):
    """A pluggable engine over all inputs; a broken file is that file's error."""
    return ocr.run_ocr(inputs(spark, sf_dir), PathReader, "page")


@query("queue_count", f"with {INPUTS} select count(*) as n from (select * from inputs order by id limit 50 offset 100)")
def queue_count(spark, sf_dir):
    """How many a page of a queue holds."""
    return queues.page(inputs(spark, sf_dir), 50, 100).agg(F.count("*").alias("n"))


class WordClassifier(ner.TokenClassifier):
    """Marks the word "the" as a patient and "ID" labels on "of", to be scaled; everything else is "O"."""

    def classify(self, texts):
        kinds = {"the": "PATIENT", "of": "ID"}
        return [[(kinds.get(t[a:b], "O"), a, b, 0.5) for a, b in self.tokens(t)] for t in texts]


@query(
    "model_spans",
    """select doc_id, entity, count(*) as n, case entity when 'ID' then 0.5::double * 0.4::double else 0.5::double end as score from
    (select doc_id, case w when 'the' then 'PERSON' else 'ID' end entity from (select doc_id, unnest(string_split_regex(text, '\\s+')) w from documents) where w in ('the', 'of')) group by all""",
)
def model_spans(spark, sf_dir):
    """Spans of a classifier over overlapping windows, merged, mapped and scaled."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = ner.classify(docs, WordClassifier, ner.NerSettings(window=40, stride=6)).select("doc_id", F.explode("model_spans").alias("s"))
    return found.groupBy("doc_id", F.col("s.entity").alias("entity"), F.col("s.score").alias("score")).agg(F.count("*").alias("n"))


@query("register_placeholders", f"with {INPUTS} select id as input_id, nullif(regexp_extract(input_file, '094-[0-9]{{6}}'), '') as subject_id, null::int as year_in_study, null::timestamp as visit_date, null::timestamp as extracted_date from inputs")
def register_placeholders(spark, sf_dir):
    """The metadata rows that registration adds."""
    return placeholders(inputs(spark, sf_dir).select("id", P.subject_id(P.dirname(F.col("input_file"))).alias("subject_id")))


@query("catalog_round_trip", f"with {INPUTS} select 1::bigint as version, id, document_type, input_file from inputs union all select 2, id, document_type, input_file from inputs where id % 2 = 0")
def catalog_round_trip(spark, sf_dir):
    """Tables installed, written twice and read: a reader keeps the version that it began with."""
    catalog = Catalog(spark, fresh_folder(spark, "catalog"))
    catalog.install()
    rows = inputs(spark, sf_dir).withColumn("created", F.lit(AS_OF).cast("timestamp_ntz"))
    catalog.append("transcription_input", rows)
    first = catalog.read("transcription_input").withColumn("version", F.lit(1).cast("long"))
    catalog.write("transcription_input", catalog.read("transcription_input").where("id % 2 = 0"))
    second = catalog.read("transcription_input").withColumn("version", F.lit(2).cast("long"))
    return first.unionByName(second).select("version", "id", "document_type", "input_file")


@query("lists_read", "select c_custkey::varchar as id, c_name as first, nullif(replace(c_mktsegment, 'A', 'x\n\"y'), '') as second from customer")
def lists_read(spark, sf_dir):
    """Rows of a delimited file, every value a string, with quotes and new-lines in cells."""
    path = fresh_folder(spark, "list") + ".tsv"
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("first"), F.replace("c_mktsegment", F.lit("A"), F.lit('x\n"y')).alias("second"))
    rows.write.options(header=True, sep="\t", quote='"', escape='"').csv(path)
    return read_list(spark, path)


@query(
    "files_written",
    f"with {INPUTS} select nullif(regexp_extract(input_file, '094-[0-9]{{6}}'), '') as subject_id, 't' || id as stem, md5(text) as digest, false as failed from inputs join documents on doc_id = id where text <> ''",
)
def files_written(spark, sf_dir):
    """Each text written to a file, the folder walked, and each file read again."""
    root = fresh_folder(spark, "texts").removeprefix("file://")
    docs = inputs(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "text"), F.col("doc_id") == F.col("id"))
    name = F.concat_ws("/", F.lit(root), P.basename(P.dirname(F.col("input_file"))), F.concat(F.lit("t"), F.col("id"), F.lit(".txt")))
    write_texts(docs.select(name.alias("path"), "text"))
    read = read_each(list_files(spark, root))
    return read.select(P.subject_id(F.col("directory")).alias("subject_id"), P.stem(F.col("path")).alias("stem"), F.md5(F.col("text").cast("binary")).alias("digest"), F.col("error").isNotNull().alias("failed"))


@query("files_failed", f"with {OUTPUTS} select id, ocr_output_file is not null as named, true as failed from outputs")
def files_failed(spark, sf_dir):
    """Files that aren't there, and rows without a path: an error for each."""
    read = read_each(outputs(spark, sf_dir).select("id", "ocr_output_file"), "ocr_output_file")
    return read.select("id", F.col("ocr_output_file").isNotNull().alias("named"), (F.col("error").isNotNull() & F.col("text").isNull()).alias("failed"))

"""Registered queries: Spark side (``QUERIES``) and DuckDB oracle (``ORACLE``).

Every query reads the driver tables in full (orders, customer, lineitem,
events) or data Spark derives from them. Payload documents are built from
those tables (see :mod:`workloads.docbuild`), flattened by the library, and
compared with plain SQL over the same tables.
"""

from __future__ import annotations

import contextlib
import os

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unfurl import (
    BM,
    BM_XML,
    CEP_XML,
    SCAN,
    apply_mapping,
    flatten_json,
    flatten_xml,
    json_outcomes,
    json_rejects,
    map_to_columns,
    path_census,
    previous_day,
    read_export,
    read_table,
    replace_table,
    spec_from_census,
    sql_file,
    sql_over,
    unnest_typed,
    write_outcomes,
    write_parquet,
    xml_outcomes,
    xml_rejects,
)
from unfurl.plans.spec import FlattenSpec, Group
from unfurl.session import scratch_path
from unfurl.sinks.files import CSV_READ_OPTIONS, write_csv
from unfurl.sources import export_lines, export_rejects

from . import templates
from .docbuild import (
    Doc,
    XmlDoc,
    dq,
    oracle_columns,
    oracle_leg_pivot,
    ranked_lines_sql,
    spark_json_doc,
    spark_xml_doc,
)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``."""
    return scratch_path(spark, name)


DATE = "CAST(CAST({} AS DATE) AS STRING)"
KEYS = {
    "pk": "CAST(o.o_orderkey AS VARCHAR)",
    "sk": "o.o_orderpriority",
    "upsertTimestamp": "CAST(o.o_orderdate AS VARCHAR)",
}
SPARK_KEYS = "CAST(o.o_orderkey AS STRING) AS pk, o.o_orderpriority AS sk, CAST(o.o_orderdate AS STRING) AS upsertTimestamp"

# ---------------------------------------------------------------------------
# Documents
# ---------------------------------------------------------------------------
_R = "bag_resp/resp_info[0]"
SCAN_DOC = Doc(
    SCAN,
    fill={
        "dev_id": "o.o_custkey",
        "ver": "o.o_orderpriority",
        "action_cd": "o.o_orderstatus",
        "stn_cd": "c.c_mktsegment",
        "ret_code": "o.o_orderkey",
        "pax_info_fn": "c.c_name",
        "pax_info_pax_stat": "c.c_nationkey",
        "flt_info_flt_nbr": "o.o_orderkey",
        "flt_info_lcl_sch_dep_dtm": DATE.format("o.o_orderdate"),
        "flt_info_priority_bag": "(o.o_orderstatus = 'F')",
        "bag_tag_tag_nbr": "o.o_orderkey * 10 + 1",
        "last_action_stn": "o.o_orderpriority",
        "clm_info_wt_ref_nbr": "c.c_custkey",
        "flt_svc_ret_code": "o.o_orderstatus",
        "flt_avlb_flt_info_dest": "c.c_name",
        "resp_info_storage_loc": "CAST(round(o.o_totalprice * 100) AS BIGINT)",
        "print_type": "c.c_mktsegment",
        "total_city_bags": "o.o_custkey",
        "tb_by_sector_count": "c.c_nationkey",
        "br_trans_res_pax_info_fn": "c.c_name",
        "br_trans_res_flt_info_flt_nbr": "o.o_custkey",  # under the key with a trailing space
        "br_trans_batch_res_pax_info_tag_nbr": "o.o_orderkey",
        "br_trans_batch_res_flt_info_legSeqNbr": "o.o_orderkey",
    },
    legs={
        f"{_R}/curr_itin/flt_info": {
            "flt_nbr": "l.l_linenumber",
            "carr_cd": "l.l_returnflag",
            "orig": "l.l_linestatus",
            "dest": "l.l_partkey",
            "gate": "l.l_suppkey",
            "intl_ind": "(l.l_returnflag = 'R')",
            "lcl_sch_dep_dtm": DATE.format("l.l_shipdate"),
            "flt_status": "CAST(l.l_quantity AS BIGINT)",
        },
    },
    keys=KEYS,
)

_B = "bagResp/bagRespInfo"
BM_DOC = Doc(
    BM,
    fill={
        "scannerID": "o.o_custkey",
        "version": "o.o_orderpriority",
        "storageLocation": "o.o_orderstatus",
        "correlationID": "o.o_orderkey",
        "responseCode": "o.o_orderstatus",
        "bagKey": "o.o_orderkey * 7",
        "firstName": "c.c_name",
        "bagRespInfo_flightNumber": "o.o_orderkey",
        "bagRespInfo_departureDate": DATE.format("o.o_orderdate"),
        "bagRespInfo_isPriority": "(o.o_orderpriority = '1-URGENT')",
        "lastAction1_remark": "c.c_mktsegment",
        "lastAction2_stageID": "c.c_nationkey",
        "loadStatus": "o.o_orderpriority",
        "bagTags_lastAction_scanStation": "o.o_orderstatus",
        "printReturnCode": "o.o_orderkey",
        "print_printType": "c.c_mktsegment",
        "bagCount_totalBagCount": "o.o_custkey",
        "totalCityBags": "o.o_custkey",
        "missingBagSummaryBySector_tbBysector_count": "c.c_nationkey",
        "brTransRes_bagtag_bagTagNumber": "o.o_orderkey",
        "brTransRes_scannedFltInfo_flightNumber": "o.o_orderkey",
        "brTransRes_currentItin_opsLegSequenceNumber": "o.o_custkey",
        "ConnectionBags_destination": "c.c_name",
        "bagTagsWCHR_fwdCount": "c.c_nationkey",
        "scanService_flightInfo_departureDate": DATE.format("o.o_orderdate"),
        "xclrIndicators_xCLRStatus": "(o.o_orderstatus = 'F')",
        "bagInfoList_bagtag_bagTagNumber": "o.o_orderkey",
    },
    legs={
        f"{_B}/currentItin/flightInfo": {
            "flightNumber": "l.l_linenumber",
            "carrierCode": "l.l_returnflag",
            "departureStation": "l.l_linestatus",
            "arrivalStation": "l.l_partkey",
            "departureGate": "l.l_suppkey",
            "localScheduledDepartureDate": DATE.format("l.l_shipdate"),
        },
        f"{_B}/selectedFlights/flightInfo": {
            "flightNumber": "l.l_suppkey",
            "departureDate": DATE.format("l.l_shipdate"),
            "opsLegSequenceNumber": "CAST(l.l_quantity AS BIGINT)",
        },
    },
    keys=KEYS,
    # the subtree totalTransferBags is also read as a leaf: its JSON text
    oracle_override={
        "totalTransferBags": "'{\"tbBysector\":{\"count\":' || CAST(c.c_nationkey AS VARCHAR) || '}}'",
    },
)

_D = "Envelope/Body/bagDetails"
_XML_SCANS = (
    "concat('<bagScans><bagScanDtl><fltNbr>', CAST(o.o_orderkey AS STRING), '</fltNbr><scanType>', "
    "o.o_orderstatus, '</scanType></bagScanDtl></bagScans>')"
)


def _xml_doc(spec, extra_fill, leg_fields):
    fill = {
        "eventName": "o.o_orderstatus",
        "eventID": "o.o_orderkey",
        "eventCreationDtm": DATE.format("o.o_orderdate"),
        "version": "c.c_nationkey",
        "tagNbr": "o.o_orderkey",
        "tagIssDtm": DATE.format("o.o_orderdate"),
        "bagOrigArpt": "c.c_mktsegment",
        "isRush": "(o.o_orderstatus = 'O')",
        "printerId": "o.o_custkey",
        "psgrLastName": "c.c_name",
        "psgrPnr": "o.o_orderpriority",
        **extra_fill,
    }
    return XmlDoc(
        spec,
        fill=fill,
        legs={
            f"{_D}/bagCurrentItineraries/bagItineraryDtl": leg_fields,
            f"{_D}/bagOriginalItineraries/bagItineraryDtl": {"fltNbr": "l.l_partkey", "origArptCd": "l.l_linestatus"},
        },
        keys=KEYS,
        root_open='<Envelope xmlns="urn:bag:envelope" xmlns:h="urn:bag:header">',
        tag_prefix={"eventHeader": "h", "eventName": "h", "eventID": "h", "eventCreationDtm": "h", "version": "h"},
        # an attribute on the parent wins over the child of the same name
        attrs={"Envelope/eventHeader": "CASE WHEN o.o_orderstatus = 'F' THEN concat(' version=\"v', o.o_orderpriority, '\"') ELSE '' END"},
        raw={_D: _XML_SCANS},
        oracle_override={
            "version": "CASE WHEN o.o_orderstatus = 'F' THEN 'v' || o.o_orderpriority ELSE CAST(c.c_nationkey AS VARCHAR) END",
        },
    )


CEP_DOC = _xml_doc(
    CEP_XML,
    {"bagTagActvInd": "(o.o_orderpriority = '2-HIGH')"},
    {"fltNbr": "l.l_linenumber", "carrIataCd": "l.l_returnflag", "legLclDepDt": DATE.format("l.l_shipdate"),
     "bagStatus": "l.l_suppkey", "isBM": "(l.l_linestatus = 'F')"},
)
BM_XML_DOC = _xml_doc(
    BM_XML,
    {"TagTypeCd": "o.o_orderstatus", "Priority": "o.o_orderpriority"},
    {"fltNbr": "l.l_linenumber", "carrIataCd": "l.l_returnflag", "isActionLeg": "(l.l_linestatus = 'O')",
     "bagStatus": "l.l_suppkey"},
)


# ---------------------------------------------------------------------------
# Spark side: payload tables
# ---------------------------------------------------------------------------
# all lines of an order, in a total order: the struct starts with what orders them
LEG_STRUCT = (
    "named_struct('l_linenumber', l_linenumber, 'l_partkey', l_partkey, 'l_suppkey', l_suppkey, "
    "'l_quantity', l_quantity, 'l_extendedprice', l_extendedprice, "
    "'l_returnflag', l_returnflag, 'l_linestatus', l_linestatus, 'l_shipdate', l_shipdate)"
)


# what documents take of a customer: one column, whose fields the document SQL names as it would a joined table's
CUSTOMER_STRUCT = "named_struct('c_custkey', c_custkey, 'c_name', c_name, 'c_nationkey', c_nationkey, 'c_mktsegment', c_mktsegment)"


def _source_sql(doc_sql: str, payload: str, tasks: int) -> str:
    # literal braces in the document SQL must not be read as frame placeholders
    doc_sql = doc_sql.replace("{", "{{").replace("}", "}}")
    return f"""
        WITH lines AS (SELECT /*+ REPARTITION({tasks}, l_orderkey) */ * FROM {{lineitem}}),
        legs AS (SELECT l_orderkey, sort_array(collect_list({LEG_STRUCT})) AS legs FROM lines GROUP BY l_orderkey),
        served AS (
            SELECT /*+ REPARTITION({tasks}, o_orderkey) */ orders.*, {CUSTOMER_STRUCT} AS c
            FROM {{orders}} orders LEFT JOIN {{customer}} customer ON o_custkey = c_custkey)
        SELECT /*+ MERGE(legs) */ {SPARK_KEYS}, {_once(doc_sql)} AS {payload}
        FROM served o LEFT JOIN legs ON o.o_orderkey = legs.l_orderkey
    """


def _once(doc_sql: str) -> str:
    """A document as the output of a generator: a condition on it then looks at the finished text, where it would
    else be pushed below a projection (and a repartition) and build every document a second time."""
    return f"explode(array({doc_sql}))"


#: Orders whose documents (a few KB each) one task makes and reads; a task sets its wide projections up anew, about a second of work.
DOCUMENTS_PER_TASK = 100_000


def _tasks(rows: DataFrame, per_task: int) -> int:
    """Tasks for so many rows, at least one for each core."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // per_task))


def payload_table(spark: SparkSession, sf_dir: str, doc_sql: str, payload: str) -> DataFrame:
    """One payload document per order, with all of the order's lines.

    Customers join orders while these are small rows; the lines of an order then meet it in one of as many
    tasks as the number of orders asks for, and are grouped, joined (a merge join: Spark's size estimate does
    not see the collected lines and would broadcast them) and made a document there, so neither lines nor
    documents are shuffled again. A document is one row by nature, so its lines meet in one task.
    """
    frames = {name: _t(spark, sf_dir, name) for name in ("orders", "customer", "lineitem")}
    return sql_over(spark, _source_sql(doc_sql, payload, _tasks(frames["orders"], DOCUMENTS_PER_TASK)), frames)


def scan_payloads(spark, sf_dir):
    return payload_table(spark, sf_dir, spark_json_doc(SCAN_DOC), "scanResponse")


def bm_payloads(spark, sf_dir):
    return payload_table(spark, sf_dir, spark_json_doc(BM_DOC), "bmResponse")


def cep_payloads(spark, sf_dir):
    return payload_table(spark, sf_dir, spark_xml_doc(CEP_DOC), "cepPayload")


# damaged XML documents, by order priority:
#   1-URGENT: <paxInfo/> (intermediate element without children)
#   2-HIGH:   a second bagScanDtl (repeated scan detail)
#   3-MEDIUM: text after the root element, or text that closes the parser's wrapper itself
#   4-NOT SPECIFIED: truncated document (malformed)
#   5-LOW:    intact (still subject to the leg-count rule)
def _damage_xml(xml: str) -> str:
    return (
        "CASE o.o_orderpriority "
        f"WHEN '1-URGENT' THEN regexp_replace({xml}, '<paxInfo>.*</paxInfo>', '<paxInfo/>') "
        f"WHEN '2-HIGH' THEN replace({xml}, '</bagScans>', '<bagScanDtl><x>1</x></bagScanDtl></bagScans>') "
        f"WHEN '3-MEDIUM' THEN concat({xml}, CASE o.o_orderstatus WHEN 'F' THEN ' tail' WHEN 'O' THEN '</w>junk <<<' ELSE '</w><w>' END) "
        f"WHEN '4-NOT SPECIFIED' THEN substring({xml}, 1, length({xml}) - 3) "
        f"ELSE {xml} END"
    )


def damaged_cep_payloads(spark, sf_dir):
    return payload_table(spark, sf_dir, spark_xml_doc(CEP_DOC, damage=_damage_xml), "cepPayload")


def bm_xml_payloads(spark, sf_dir):
    return payload_table(spark, sf_dir, spark_xml_doc(BM_XML_DOC), "bmPayload")


# damaged scan documents, by order priority:
#   1-URGENT: resp_info = []            (first element of an empty array)
#   2-HIGH:   hdr = null                (explicit null intermediate)
#   3-MEDIUM: curr_itin.flt_info = "x"  (leg array that is a non-empty string)
#   4-NOT SPECIFIED: trailing garbage after the document, with and without a bracket that closes the parser's wrapper
#   5-LOW:    intact; hdr missing when o_orderstatus = 'P' (missing node: NULL leaves)
DAMAGED_SCAN_DOC = Doc(
    SCAN,
    fill=SCAN_DOC.fill,
    legs=SCAN_DOC.legs,
    keys=KEYS,
    overrides={
        "bag_resp/hdr": [("o.o_orderpriority = '2-HIGH'", "parse_json('null')"),
                         ("o.o_orderstatus = 'P'", "CAST(NULL AS VARIANT)")],
        "bag_resp/resp_info[0]": [("o.o_orderpriority = '1-URGENT'", "parse_json('[]')")],
        "bag_resp/resp_info[0]/curr_itin": [("o.o_orderpriority = '3-MEDIUM'", "parse_json('{\"flt_info\":\"x\"}')")],
    },
)


def damaged_scan_payloads(spark, sf_dir):
    doc = spark_json_doc(DAMAGED_SCAN_DOC)
    doc = f"CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN concat({doc}, CASE o.o_orderstatus WHEN 'F' THEN ' x' WHEN 'O' THEN '] x {{{{{{' ELSE '],[1]' END) ELSE {doc} END"
    return payload_table(spark, sf_dir, doc, "scanResponse")


def _hdr(name):
    return name in ("dev_id", "mac_id", "ver", "serial_nbr", "action_cd", "stn_cd")


def _under_r(name):
    idx = SCAN_DOC.leaf_index()
    return name in idx and idx[name][0].path.startswith(_R)


def _curr_legs(name):
    return name.startswith("resp_curritnr_")


STRICT_VISIBLE = [(_hdr, "o.o_orderstatus <> 'P'")]
LENIENT_VISIBLE = [
    (_hdr, "o.o_orderstatus <> 'P' AND o.o_orderpriority <> '2-HIGH'"),
    (_under_r, "o.o_orderpriority <> '1-URGENT'"),
    (_curr_legs, "o.o_orderpriority <> '3-MEDIUM'"),
]


# ---------------------------------------------------------------------------
# Oracle side
# ---------------------------------------------------------------------------
def _oracle_flat(doc: Doc, slots: int, where: str = "", visible=None, pivot_slots: int | None = None) -> str:
    d = doc if visible is None else Doc(doc.spec, doc.fill, doc.legs, doc.keys, visible=visible,
                                       oracle_override=doc.oracle_override)
    pivot = oracle_leg_pivot(d, ranked_lines_sql("lineitem", slots), pivot_slots or slots)
    return (
        f"WITH lp AS ({pivot}) SELECT {', '.join(oracle_columns(d))} "
        f"FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey "
        f"LEFT JOIN lp ON o.o_orderkey = lp.l_orderkey {where}"
    )


def _oracle_xml(doc: Doc, where: str) -> str:
    pivot = oracle_leg_pivot(doc, ranked_lines_sql("lineitem", 1), 1)
    return (
        f"WITH lp AS ({pivot}), lc AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) "
        f"SELECT {', '.join(oracle_columns(doc))} FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey "
        f"LEFT JOIN lp ON o.o_orderkey = lp.l_orderkey LEFT JOIN lc ON o.o_orderkey = lc.l_orderkey {where}"
    )


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------
EVENTS_SPEC = FlattenSpec("events_props", (Group("", ("k",)),), key_columns=("event_id", "user_id", "event_type"))


def q_json_object(spark, sf_dir):
    return flatten_json(_t(spark, sf_dir, "events"), "props", EVENTS_SPEC)


def q_scan_flat(spark, sf_dir):
    return flatten_json(scan_payloads(spark, sf_dir), "scanResponse", SCAN)


def q_bm_flat(spark, sf_dir):
    return flatten_json(bm_payloads(spark, sf_dir), "bmResponse", BM)


def q_json_strict_drop(spark, sf_dir):
    return flatten_json(damaged_scan_payloads(spark, sf_dir), "scanResponse", SCAN)


def q_json_lenient(spark, sf_dir):
    return flatten_json(damaged_scan_payloads(spark, sf_dir), "scanResponse", SCAN, strict=False)


def q_json_reject_count(spark, sf_dir):
    rej = json_rejects(damaged_scan_payloads(spark, sf_dir), "scanResponse", SCAN)
    return rej.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def q_cep_xml_flat(spark, sf_dir):
    return flatten_xml(cep_payloads(spark, sf_dir), "cepPayload", CEP_XML)


def q_bm_xml_flat(spark, sf_dir):
    return flatten_xml(bm_xml_payloads(spark, sf_dir), "bmPayload", BM_XML)


def q_xml_single_leg_keep(spark, sf_dir):
    return flatten_xml(cep_payloads(spark, sf_dir), "cepPayload", CEP_XML, single_leg="keep")


def q_xml_strict_drop(spark, sf_dir):
    return flatten_xml(damaged_cep_payloads(spark, sf_dir), "cepPayload", CEP_XML)


def q_xml_lenient(spark, sf_dir):
    return flatten_xml(damaged_cep_payloads(spark, sf_dir), "cepPayload", CEP_XML, strict=False)


def q_cep_scan_detail(spark, sf_dir):
    return flatten_xml(cep_payloads(spark, sf_dir), "cepPayload", CEP_XML, emit_scan_detail=True)


def q_xml_reject_count(spark, sf_dir):
    rej = xml_rejects(cep_payloads(spark, sf_dir), "cepPayload", CEP_XML)
    return rej.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def _orders_stamped(spark, sf_dir):
    return _t(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderstatus",
        "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'bad' "
        "ELSE CAST(o_orderdate AS STRING) END AS upsertTimestamp",
    )


PREV_DAY_RUN = "1995-01-02"


def q_prev_day_inclusive(spark, sf_dir):
    return previous_day(_orders_stamped(spark, sf_dir), run_date=PREV_DAY_RUN)


def q_prev_day_half_open(spark, sf_dir):
    return previous_day(_orders_stamped(spark, sf_dir), run_date=PREV_DAY_RUN, inclusive_end=False)


LINE_MAPPING = [
    ("l_orderkey", "bigint", "order_id", "string"),
    ("L_LINENUMBER", "int", "line_no", "string"),
    ("l_quantity", "double", "qty", "int"),
    ("l_returnflag", "string", "flag", "string"),
    ("l_shipdate", "timestamp", "ship_day", "date"),
]


def q_apply_mapping(spark, sf_dir):
    m = apply_mapping(_t(spark, sf_dir, "lineitem"), LINE_MAPPING)
    return m.withColumn("ship_day", F.col("ship_day").cast("string"))


def q_map_to_columns(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS pk",
        "map('status', o_orderstatus, 'priority', o_orderpriority, 'day', CAST(CAST(o_orderdate AS DATE) AS STRING)) AS m",
    )
    return map_to_columns(o, "m", ["status", "priority", "day", "missing"], keep=["pk"])


COMPARE_SQL = """
SELECT s.pk, s.sk,
       s.ret_code AS scan_ret_code,
       b.correlationID AS bm_correlation_id,
       b.storageLocation AS bm_storage_location,
       (s.action_cd = b.responseCode) AS same_status
FROM {scan} s JOIN {bm} b ON s.pk = b.pk AND s.sk = b.sk
"""


def q_sql_over(spark, sf_dir):
    frames = {"scan": q_scan_flat(spark, sf_dir), "bm": q_bm_flat(spark, sf_dir)}
    return sql_over(spark, COMPARE_SQL, frames)


def q_sql_file(spark, sf_dir):
    # the stored query is multi-line text over the views `scan` and `bm`
    path = _scratch(spark, "query")
    text = COMPARE_SQL.replace("{scan}", "scan").replace("{bm}", "bm")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    frames = {"scan": q_scan_flat(spark, sf_dir), "bm": q_bm_flat(spark, sf_dir)}
    return sql_file(spark, path, frames)


def q_unnest_typed(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    items = c.selectExpr(
        "to_json(named_struct('Item', named_struct("
        "'pk', named_struct('S', c_name), "
        "'nation', named_struct('N', CAST(c_nationkey AS STRING)), "
        "'positive', named_struct('BOOL', c_acctbal > 0), "
        "'gone', named_struct('NULL', true), "
        "'seg', named_struct('M', named_struct('name', named_struct('S', c_mktsegment)))))) AS value"
    )
    return unnest_typed(items, "value", ["pk", "nation", "positive", "gone", "seg", "absent"])


def q_parquet_round_trip(spark, sf_dir):
    path = _scratch(spark, "parquet")
    write_parquet(q_cep_xml_flat(spark, sf_dir), path)
    return spark.read.parquet(path)


def q_csv_round_trip(spark, sf_dir):
    # distributed CSV parts (the single-file form is one writer task; its text is
    # checked against pandas in tests/test_relational.py)
    path = _scratch(spark, "csv")
    flat = q_bm_xml_flat(spark, sf_dir)
    write_csv(flat, path)
    return spark.read.options(**CSV_READ_OPTIONS).schema(flat.schema).csv(path)


def q_streaming_flatten(spark, sf_dir):
    from unfurl.streaming import flatten_new_files

    sink = _scratch(spark, "stream-out")
    ckpt = _scratch(spark, "stream-ckpt")
    q = flatten_new_files(
        # a glob: the file source watches a folder (pattern), not a single file
        spark, os.path.join(sf_dir, "events*.parquet"),
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
        "props", EVENTS_SPEC, sink, checkpoint=ckpt,
    )
    q.awaitTermination()
    return spark.read.parquet(sink)


NUMBERS_SPEC = FlattenSpec("numbers", (Group("n", ("price", "qty", "tax", "tiny", "big", "digits")), Group("n/legs", ("v",), "leg_", "legs", 2)),
                           key_columns=("order_id", "line_no"))


def q_json_numbers(spark, sf_dir):
    # number texts as a writer may put them: trailing zeros, many digits, small and large powers
    lines = _t(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS order_id", "CAST(l_linenumber AS STRING) AS line_no",
        "concat('{\"n\":{\"price\":', CAST(l_partkey AS STRING), '.50,\"qty\":', CAST(CAST(l_quantity AS INT) AS STRING), '.0,\"tax\":0.000', CAST(l_linenumber AS STRING), "
        "',\"tiny\":', CAST(l_linenumber AS STRING), 'e-7,\"big\":', CAST(l_linenumber AS STRING), '2345678.5,\"digits\":', CAST(l_suppkey + 1 AS STRING), '00000000000000000000001,"
        "\"legs\":[{\"v\":', CAST(l_suppkey AS STRING), '.0},{\"v\":-0.0},7]}}') AS doc")
    return flatten_json(lines, "doc", NUMBERS_SPEC)


#: Rows that one task or one file takes: documents of up to 150 MB of text, made one at a time; items of an export file, which is not split.
ORDERS_PER_TASK, ITEMS_PER_FILE = 8_000, 25_000


def _dealt(rows: DataFrame, per_task: int) -> DataFrame:
    """Small rows, often few splits, dealt by number before larger texts are made of them."""
    return rows.repartition(_tasks(rows, per_task))


def _export_folder(spark, sf_dir):
    """Customers as export files: type-tagged JSON lines, written by Spark."""
    path = _scratch(spark, "export")
    _dealt(_t(spark, sf_dir, "customer"), ITEMS_PER_FILE).selectExpr(
        "CASE WHEN c_nationkey = 3 THEN '{\"Item\":{\"pk\"' ELSE to_json(named_struct('Item', named_struct("
        "'pk', named_struct('S', c_name), 'stationCode', named_struct('S', c_mktsegment), "
        "'active', named_struct('BOOL', c_acctbal > 0), "
        "'place', named_struct('M', named_struct('nation', named_struct('N', CAST(c_nationkey AS STRING)), "
        "'tags', named_struct('L', array(named_struct('S', c_mktsegment)))))))) END AS value"
    ).write.option("compression", "gzip").text(path)
    return path


def q_read_export_all(spark, sf_dir):
    return read_export(spark, _export_folder(spark, sf_dir))


NESTED_LEVELS = 12


def q_unnest_nested(spark, sf_dir):
    # maps and lists in turn around a text with line separators, sets and binary
    deep = "named_struct('S', concat(c_name, '\u2028x\u0085'))"
    for level in range(NESTED_LEVELS):
        deep = f"named_struct('M', named_struct('k', {deep}))" if level % 2 else f"named_struct('L', array({deep}))"
    path = _scratch(spark, "export-nested")
    _dealt(_t(spark, sf_dir, "customer").where("c_nationkey <> 3"), ITEMS_PER_FILE).selectExpr(
        "to_json(named_struct('Item', named_struct('pk', named_struct('S', c_name), "
        "'place', named_struct('M', named_struct('nation', named_struct('N', CAST(c_nationkey AS STRING)), 'tags', named_struct('L', array(named_struct('S', c_mktsegment))))), "
        f"'deep', {deep}, 'seen', named_struct('SS', array(c_mktsegment, c_name)), 'counts', named_struct('NS', array(CAST(c_custkey AS STRING), '1')), 'raw', named_struct('B', 'AA==')))) AS value"
    ).write.option("compression", "gzip").text(path)
    return read_export(spark, path, ["pk", "place", "deep", "seen", "counts", "raw"])


def q_export_reject_count(spark, sf_dir):
    bad = export_rejects(export_lines(spark, _export_folder(spark, sf_dir)), "value")
    return bad.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


def q_read_table(spark, sf_dir):
    return read_table(spark, os.path.join(sf_dir, "supplier.parquet")).select("s_suppkey", "s_nationkey")


def q_kept_rows(spark, sf_dir):
    kept = flatten_json(damaged_scan_payloads(spark, sf_dir), "scanResponse", SCAN)
    return kept.agg(F.count(F.lit(1)).alias("n"))


def q_prev_day_default(spark, sf_dir):
    # stamped relative to today: one, two or no day back, by order key
    stamped = _t(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CAST(date_sub(current_date(), CAST(o_orderkey % 3 AS INT)) AS STRING) || ' 12:00:00' AS upsertTimestamp")
    return previous_day(stamped).select("o_orderkey")


def _filled(spark, sf_dir, name, payload):
    orders = _dealt(_t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate"), ORDERS_PER_TASK)
    *keys, document = templates.spark_sql(name, payload)
    text, alias = document.rsplit(" AS ", 1)
    return orders.selectExpr(*keys, f"{_once(text)} AS {alias}")


def q_scan_every_field(spark, sf_dir):
    return flatten_json(_filled(spark, sf_dir, "scan.json", "scanResponse"), "scanResponse", SCAN)


def q_bm_every_field(spark, sf_dir):
    return flatten_json(_filled(spark, sf_dir, "bm.json", "bmResponse"), "bmResponse", BM)


def q_cep_xml_every_field(spark, sf_dir):
    return flatten_xml(_filled(spark, sf_dir, "cep.xml", "cepPayload"), "cepPayload", CEP_XML)


def q_bm_xml_every_field(spark, sf_dir):
    return flatten_xml(_filled(spark, sf_dir, "bm.xml", "bmPayload"), "bmPayload", BM_XML)


NON_FINITE_SPEC = FlattenSpec("non_finite", (Group("n", ("v", "w")), Group("n/legs", ("v",), "leg_", "legs", 2)), key_columns=("order_id", "line_no"))


def q_json_non_finite(spark, sf_dir):
    # what lenient writers emit: literals without digits, numbers that overflow; texts that only look like them; malformed uses
    lines = _t(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS order_id", "CAST(l_linenumber AS STRING) AS line_no",
        "concat('{\"n\":{\"w\":', CAST(l_suppkey AS STRING), ',', CASE l_partkey % 8 WHEN 0 THEN '\"v\":NaN' WHEN 1 THEN '\"v\": -Infinity ' WHEN 2 THEN '\"v\":1e400' "
        "WHEN 3 THEN concat('\"v\":\"NaN \\\\\" Infinity ', CAST(l_partkey AS STRING), '\"') WHEN 4 THEN '\"legs\":[{\"v\":Infinity},{\"v\":-2.5E+999},NaN]' "
        "WHEN 5 THEN 'NaN:1' WHEN 6 THEN '\"v\":-NaN' ELSE '\"v\":{\"x\":[NaN,1]}' END, '}}') AS doc")
    return flatten_json(lines, "doc", NON_FINITE_SPEC)


NAMES_SPEC = FlattenSpec("names", (Group("Envelope/Body", ("tagNbr", "status")),), key_columns=("pk",))


def q_xml_scopes(spark, sf_dir):
    # prefixes in and out of scope, document types with and without entities, names in another case, prefixed attributes
    orders = _t(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS pk", "to_json(named_struct('text', concat("
        "CASE o_custkey % 10 WHEN 0 THEN '<!DOCTYPE Envelope>' WHEN 1 THEN '<?xml version=\"1.0\"?><!DOCTYPE Envelope [<!ENTITY s \"entity\">]>' ELSE '' END, "
        "CASE o_custkey % 10 WHEN 2 THEN '<Envelope xmlns:q=\"urn:q\">' WHEN 3 THEN '<ENVELOPE>' ELSE '<Envelope>' END, "
        "CASE o_custkey % 10 WHEN 4 THEN '<Body TAGNBR=\"9\">' WHEN 5 THEN '<Body xmlns:n=\"urn:n\" n:tagNbr=\"9\">' ELSE '<Body>' END, "
        "CASE o_custkey % 10 WHEN 2 THEN concat('<q:tagNbr>', CAST(o_orderkey AS STRING), '</q:tagNbr>') WHEN 6 THEN concat('<q:tagNbr>', CAST(o_orderkey AS STRING), '</q:tagNbr>') "
        "WHEN 7 THEN concat('<a xmlns:q=\"urn:q\"/><q:tagNbr>', CAST(o_orderkey AS STRING), '</q:tagNbr>') WHEN 8 THEN concat('<TagNbr>', CAST(o_orderkey AS STRING), '</TagNbr>') "
        "ELSE concat('<tagNbr>', CAST(o_orderkey AS STRING), '</tagNbr>') END, "
        "CASE o_custkey % 10 WHEN 1 THEN '<status>&s;</status>' WHEN 9 THEN '<status>&s;</status>' ELSE concat('<status>', o_orderstatus, '</status>') END, "
        "'</Body>', CASE o_custkey % 10 WHEN 3 THEN '</ENVELOPE>' ELSE '</Envelope>' END))) AS doc")
    return flatten_xml(orders, "doc", NAMES_SPEC)


def _outcomes(spark, name, tagged, spec):
    """Rows by outcome, counted in both tables that one write made."""
    done = write_outcomes(tagged, _scratch(spark, name), spec)
    return done.kept.agg(F.lit("kept").alias("outcome"), F.count(F.lit(1)).alias("n")).unionByName(
        done.rejects.groupBy(F.col("reject_reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n")))


def q_json_outcomes(spark, sf_dir):
    return _outcomes(spark, "json-outcomes", json_outcomes(damaged_scan_payloads(spark, sf_dir), "scanResponse", SCAN), SCAN)


def q_xml_outcomes(spark, sf_dir):
    return _outcomes(spark, "xml-outcomes", xml_outcomes(cep_payloads(spark, sf_dir), "cepPayload", CEP_XML), CEP_XML)


def q_prev_day_offsets(spark, sf_dir):
    # texts with an hour and a zone of their own, stored, so that the window's string ranges meet file statistics
    path = _scratch(spark, "stamped")
    _t(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "concat(CAST(CAST(o_orderdate AS DATE) AS STRING), CASE o_custkey % 3 WHEN 0 THEN 'T' ELSE ' ' END, lpad(CAST(o_orderkey % 24 AS STRING), 2, '0'), ':30:00', "
        "CASE WHEN o_custkey % 37 < 18 THEN '-' ELSE '+' END, lpad(CAST(abs(o_custkey % 37 - 18) AS STRING), 2, '0'), ':00') AS upsertTimestamp",
    ).repartitionByRange("upsertTimestamp").write.parquet(path)
    return previous_day(spark.read.parquet(path), run_date=PREV_DAY_RUN)


def q_replace_table(spark, sf_dir):
    # two runs over one table: the second reads what the first wrote and replaces it; the third fails on its way
    path = _scratch(spark, "replaced")
    replace_table(_t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), path)
    replace_table(read_table(spark, path).where("o_orderstatus <> 'P'"), path)
    with contextlib.suppress(PySparkException):
        replace_table(read_table(spark, path).selectExpr("o_orderkey", "CASE WHEN o_orderkey % 2 = 0 THEN raise_error('stopped') ELSE o_orderstatus END AS o_orderstatus"), path)
    return read_table(spark, path)


def q_path_census(spark, sf_dir):
    return path_census(_filled(spark, sf_dir, "scan.json", "scanResponse"), "scanResponse")


def q_census_flatten(spark, sf_dir):
    # the spec comes from the documents themselves
    events = _t(spark, sf_dir, "events")
    spec = spec_from_census(path_census(events, "props").collect(), "from_data", key_columns=("event_id", "user_id", "event_type"))
    return flatten_json(events, "props", spec)


QUERIES = {
    "path_census": q_path_census,
    "census_flatten": q_census_flatten,
    "replace_table": q_replace_table,
    "json_outcomes": q_json_outcomes,
    "xml_outcomes": q_xml_outcomes,
    "prev_day_offsets": q_prev_day_offsets,
    "json_non_finite": q_json_non_finite,
    "xml_scopes": q_xml_scopes,
    "json_object": q_json_object,
    "scan_flat": q_scan_flat,
    "bm_flat": q_bm_flat,
    "json_strict_drop": q_json_strict_drop,
    "json_lenient": q_json_lenient,
    "json_reject_count": q_json_reject_count,
    "cep_xml_flat": q_cep_xml_flat,
    "bm_xml_flat": q_bm_xml_flat,
    "xml_single_leg_keep": q_xml_single_leg_keep,
    "xml_reject_count": q_xml_reject_count,
    "xml_strict_drop": q_xml_strict_drop,
    "xml_lenient": q_xml_lenient,
    "cep_scan_detail": q_cep_scan_detail,
    "prev_day_inclusive": q_prev_day_inclusive,
    "prev_day_half_open": q_prev_day_half_open,
    "apply_mapping": q_apply_mapping,
    "map_to_columns": q_map_to_columns,
    "sql_over": q_sql_over,
    "sql_file": q_sql_file,
    "unnest_typed": q_unnest_typed,
    "parquet_round_trip": q_parquet_round_trip,
    "csv_round_trip": q_csv_round_trip,
    "streaming_flatten": q_streaming_flatten,
    "scan_every_field": q_scan_every_field,
    "bm_every_field": q_bm_every_field,
    "cep_xml_every_field": q_cep_xml_every_field,
    "bm_xml_every_field": q_bm_xml_every_field,
    "json_numbers": q_json_numbers,
    "read_export_all": q_read_export_all,
    "unnest_nested": q_unnest_nested,
    "export_reject_count": q_export_reject_count,
    "read_table": q_read_table,
    "kept_rows": q_kept_rows,
    "prev_day_default": q_prev_day_default,
}

_EVENTS_ORACLE = (
    "SELECT json_extract_string(props, '$.k') AS k, CAST(event_id AS VARCHAR) AS event_id, "
    "CAST(user_id AS VARCHAR) AS user_id, CAST(event_type AS VARCHAR) AS event_type FROM events"
)
_PREV_SRC = (
    "(SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'bad' "
    "ELSE CAST(o_orderdate AS VARCHAR) END AS upsertTimestamp FROM orders) t"
)
_PREV_TS = "TRY_CAST(upsertTimestamp AS TIMESTAMP)"
_COMPARE_ORACLE = (
    "SELECT CAST(o.o_orderkey AS VARCHAR) AS pk, o.o_orderpriority AS sk, CAST(o.o_orderkey AS VARCHAR) AS scan_ret_code, "
    "CAST(o.o_orderkey AS VARCHAR) AS bm_correlation_id, o.o_orderstatus AS bm_storage_location, "
    "(o.o_orderstatus = o.o_orderstatus) AS same_status FROM orders o"
)
_XML_WHERE = "WHERE coalesce(lc.n, 0) <> 1"
_PAX = ("psgrLastName", "psgrFirstName", "psgrPnr")
CEP_LENIENT_DOC = XmlDoc(
    CEP_XML, CEP_DOC.fill, CEP_DOC.legs, KEYS,
    visible=[(lambda c: c in _PAX, "o.o_orderpriority <> '1-URGENT'")],
    oracle_override=CEP_DOC.oracle_override,
)
_SCAN_DETAIL = [f for f in CEP_XML.extra["scan_detail"][1]]


def _oracle_scan_detail() -> str:
    base = _oracle_xml(CEP_DOC, _XML_WHERE)
    detail = {"fltNbr": "CAST(o.o_orderkey AS VARCHAR)", "scanType": "o.o_orderstatus"}
    extra = ", ".join(f"{detail.get(f, 'CAST(NULL AS VARCHAR)')} AS {dq(f)}" for f in _SCAN_DETAIL)
    return base.replace(" FROM orders o LEFT JOIN customer c", f", {extra} FROM orders o LEFT JOIN customer c", 1)
_XML_REJECTS = (
    "SELECT 'node:Envelope/Body/bagDetails/bagCurrentItineraries/bagItineraryDtl' AS reject_reason, count(*) AS n "
    "FROM orders o JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) lc "
    "ON o.o_orderkey = lc.l_orderkey WHERE lc.n = 1"
)
_JSON_REJECTS = (
    "SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'node:bag_resp/resp_info[0]' "
    "WHEN '2-HIGH' THEN 'node:bag_resp/hdr' WHEN '3-MEDIUM' THEN 'node:bag_resp/resp_info[0]/curr_itin/flt_info' "
    "ELSE 'malformed' END AS reject_reason, count(*) AS n FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1"
)

ORACLE = {
    "json_object": _EVENTS_ORACLE,
    "scan_flat": _oracle_flat(SCAN_DOC, 5),
    "bm_flat": _oracle_flat(BM_DOC, 5),
    "json_strict_drop": _oracle_flat(SCAN_DOC, 5, "WHERE o.o_orderpriority = '5-LOW'", visible=STRICT_VISIBLE),
    "json_lenient": _oracle_flat(SCAN_DOC, 5, "WHERE o.o_orderpriority <> '4-NOT SPECIFIED'", visible=LENIENT_VISIBLE),
    "json_reject_count": _JSON_REJECTS,
    "cep_xml_flat": _oracle_xml(CEP_DOC, _XML_WHERE),
    "bm_xml_flat": _oracle_xml(BM_XML_DOC, _XML_WHERE),
    "xml_single_leg_keep": _oracle_xml(CEP_DOC, ""),
    "xml_reject_count": _XML_REJECTS,
    "xml_strict_drop": _oracle_xml(CEP_DOC, _XML_WHERE + " AND o.o_orderpriority = '5-LOW'"),
    "xml_lenient": _oracle_xml(CEP_LENIENT_DOC, "WHERE o.o_orderpriority NOT IN ('3-MEDIUM', '4-NOT SPECIFIED')"),
    "cep_scan_detail": _oracle_scan_detail(),
    "prev_day_inclusive": (
        f"SELECT * FROM {_PREV_SRC} WHERE {_PREV_TS} BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1995-01-02'"
    ),
    "prev_day_half_open": (
        f"SELECT * FROM {_PREV_SRC} WHERE {_PREV_TS} >= TIMESTAMP '1995-01-01' AND {_PREV_TS} < TIMESTAMP '1995-01-02'"
    ),
    "apply_mapping": (
        "SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS line_no, "
        "TRY_CAST(l_quantity AS INTEGER) AS qty, l_returnflag AS flag, "
        "CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day FROM lineitem"
    ),
    "map_to_columns": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS pk, o_orderstatus AS status, o_orderpriority AS priority, "
        "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(NULL AS VARCHAR) AS missing FROM orders"
    ),
    "sql_over": _COMPARE_ORACLE,
    "sql_file": _COMPARE_ORACLE,
    "unnest_typed": (
        "SELECT c_name AS pk, CAST(c_nationkey AS VARCHAR) AS nation, CAST(c_acctbal > 0 AS VARCHAR) AS positive, "
        "CAST(NULL AS VARCHAR) AS gone, '{\"name\":\"' || c_mktsegment || '\"}' AS seg, "
        "CAST(NULL AS VARCHAR) AS absent FROM customer"
    ),
    "parquet_round_trip": _oracle_xml(CEP_DOC, _XML_WHERE),
    "csv_round_trip": _oracle_xml(BM_XML_DOC, _XML_WHERE),
    "streaming_flatten": _EVENTS_ORACLE,
    "scan_every_field": templates.oracle_sql("scan.json", {"error": "CAST(NULL AS VARCHAR)"}),
    # a key that is both a subtree and a leaf: its JSON text
    "bm_every_field": templates.oracle_sql("bm.json", {"totalTransferBags": (
        "'{\"tbBysector\":{\"count\":\"' || o_orderkey || '.missingBagSummaryBySector_tbBysector_count\",\"sector\":\"' "
        "|| o_orderkey || '.missingBagSummaryBySector_tbBysector_sector\"}}'")}),
    "cep_xml_every_field": templates.oracle_sql("cep.xml"),
    "bm_xml_every_field": templates.oracle_sql("bm.xml"),
    # the JVM's text of a double, written out by hand for these shapes of number
    "json_numbers": (
        "SELECT l_partkey || '.5' AS price, CAST(l_quantity AS INTEGER) || '.0' AS qty, l_linenumber || '.0E-4' AS tax, "
        "l_linenumber || '.0E-7' AS tiny, l_linenumber || '.23456785E' || 7 AS big, "
        "(l_suppkey + 1) || '00000000000000000000001' AS digits, l_suppkey || '.0' AS leg_0_v, '-0.0' AS leg_1_v, "
        "CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS line_no FROM lineitem"
    ),
    "path_census": "SELECT path, kind, k * (SELECT count(*) FROM orders) AS n FROM (VALUES {}) t(path, kind, k)".format(
        ", ".join(f"('{path}', '{kind}', {n})" for (path, kind), n in templates.census("scan.json").items())),
    "census_flatten": _EVENTS_ORACLE,
    "replace_table": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'",
    "json_outcomes": f"SELECT reject_reason AS outcome, n FROM ({_JSON_REJECTS}) UNION ALL SELECT 'kept', count(*) FROM orders WHERE o_orderpriority = '5-LOW'",
    "xml_outcomes": (f"SELECT reject_reason AS outcome, n FROM ({_XML_REJECTS}) WHERE n > 0 UNION ALL SELECT 'kept', count(*) FROM orders o "
                     f"LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) lc ON o.o_orderkey = lc.l_orderkey {_XML_WHERE}"),
    "prev_day_offsets": (
        "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || CASE o_custkey % 3 WHEN 0 THEN 'T' ELSE ' ' END || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':30:00' "
        "|| CASE WHEN o_custkey % 37 < 18 THEN '-' ELSE '+' END || lpad(CAST(abs(o_custkey % 37 - 18) AS VARCHAR), 2, '0') || ':00' AS \"upsertTimestamp\" FROM orders "
        "WHERE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_minutes(CAST((o_orderkey % 24) * 60 + 30 - (o_custkey % 37 - 18) * 60 AS INTEGER)) BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1995-01-02'"
    ),
    "json_non_finite": (
        "SELECT CASE l_partkey % 8 WHEN 0 THEN 'NaN' WHEN 1 THEN '-Infinity' WHEN 2 THEN 'Infinity' WHEN 3 THEN 'NaN \" Infinity ' || l_partkey "
        "WHEN 7 THEN '{\"x\":[\"NaN\",1]}' END AS v, CAST(l_suppkey AS VARCHAR) AS w, CASE WHEN l_partkey % 8 = 4 THEN 'Infinity' END AS leg_0_v, "
        "CASE WHEN l_partkey % 8 = 4 THEN '-Infinity' END AS leg_1_v, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS line_no "
        "FROM lineitem WHERE l_partkey % 8 NOT IN (5, 6)"
    ),
    "xml_scopes": (
        "SELECT CASE WHEN o_custkey % 10 NOT IN (3, 8) THEN CAST(o_orderkey AS VARCHAR) END AS \"tagNbr\", "
        "CASE o_custkey % 10 WHEN 1 THEN 'entity' WHEN 3 THEN NULL ELSE o_orderstatus END AS status, CAST(o_orderkey AS VARCHAR) AS pk "
        "FROM orders WHERE o_custkey % 10 NOT IN (6, 7, 9)"
    ),
    "read_export_all": (
        "SELECT c_name AS pk, c_mktsegment AS \"stationCode\", CAST(c_acctbal > 0 AS VARCHAR) AS active, "
        "'{\"nation\":' || c_nationkey || ',\"tags\":[\"' || c_mktsegment || '\"]}' AS place FROM customer WHERE c_nationkey <> 3"
    ),
    "unnest_nested": (
        "SELECT c_name AS pk, '{\"nation\":' || c_nationkey || ',\"tags\":[\"' || c_mktsegment || '\"]}' AS place, "
        f"'{'{"k":[' * (NESTED_LEVELS // 2)}\"' || c_name || chr(8232) || 'x' || chr(133) || '\"{']}' * (NESTED_LEVELS // 2)}' AS deep, "
        "'[\"' || c_mktsegment || '\",\"' || c_name || '\"]' AS seen, '[' || c_custkey || ',1]' AS counts, 'AA==' AS raw FROM customer WHERE c_nationkey <> 3"
    ),
    "export_reject_count": "SELECT '{\"Item\":{\"pk\"' AS line, count(*) AS n FROM customer WHERE c_nationkey = 3 HAVING count(*) > 0",
    "read_table": "SELECT s_suppkey, s_nationkey FROM supplier",
    "kept_rows": "SELECT count(*) AS n FROM orders WHERE o_orderpriority = '5-LOW'",
    "prev_day_default": "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 1",
}

"""The literal documents fill every payload column of every spec, and a wrong spec shows."""

from dataclasses import replace

from oracle_check import compare, duck

from unfurl import BM, BM_XML, CEP_XML, SCAN, flatten_json
from workloads import templates
from workloads.registry import ORACLE, _filled

SF = "/root/testdata/sf0.001"


def test_every_payload_column_is_filled():
    for spec, name, more in ((SCAN, "scan.json", set()), (BM, "bm.json", {"totalTransferBags"}), (CEP_XML, "cep.xml", set()), (BM_XML, "bm.xml", set())):
        named = templates.columns(name)
        assert len(named) == len(set(named))
        assert set(named) | more == set(spec.payload_columns())


def test_swapped_fields_turn_the_query_red(spark):
    g = SCAN.groups[0]
    swapped = replace(SCAN, groups=(replace(g, path="bag_resp/hdr", rename=g.rename), *SCAN.groups[1:]))
    wrong_order = replace(SCAN, groups=(replace(g, fields=g.fields, rename=((g.fields[0], g.fields[1]), (g.fields[1], g.fields[0]))), *SCAN.groups[1:]))
    for spec in (swapped, wrong_order):
        q = lambda spark, sf, spec=spec: flatten_json(_filled(spark, sf, "scan.json", "p"), "p", spec)
        assert not compare(spark, "x", q, ORACLE["scan_every_field"], SF, duck(SF))["ok"]

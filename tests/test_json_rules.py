"""Row rules of the JSON flatten (FIXTURES.md section 3)."""

import json


from unfurl.operators.json_flatten import flatten_json, json_rejects
from unfurl.plans.catalog import BM, SCAN


def run(spark, docs, spec=SCAN, strict=True, cols=None):
    rows = [(f"p{i}", f"s{i}", d, "2024-01-01T00:00:00") for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "pk string, sk string, scanResponse string, upsertTimestamp string")
    out = flatten_json(df, "scanResponse", spec, strict=strict)
    got = {r["pk"]: r.asDict() for r in out.collect()}
    return [got.get(f"p{i}") for i in range(len(docs))]


def kept(res):
    return [r is not None for r in res]


def test_j1_empty_object_kept_all_null(spark):
    (r,) = run(spark, ["{}"])
    assert r is not None
    assert all(v is None for k, v in r.items() if k not in ("pk", "sk", "upsertTimestamp"))
    assert list(r.keys()) == SCAN.columns()


def test_j2_j3_malformed_and_non_object_dropped(spark):
    docs = [None, "", "nope", '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', "[1]", "null", "5", '"s"']
    assert kept(run(spark, docs)) == [False] * len(docs)


def test_j4_intermediate_wrong_kind_dropped(spark):
    docs = ['{"bag_resp":null}', '{"bag_resp":"x"}', '{"bag_resp":[]}', '{"bag_resp":{"hdr":5}}']
    assert kept(run(spark, docs)) == [False] * 4


def test_j5_j6_j7_leaf_text(spark):
    docs = [
        '{"bag_resp":{"ret_code":null,"error_msg":"e"}}',
        '{"bag_resp":{"ret_code":{"a":1}}}',
        '{"bag_resp":{"ret_code":5}}',
        '{"bag_resp":{"ret_code":true}}',
        '{"bag_resp":{"ret_code":"007"}}',
        '{"bag_resp":{"ret_code":1.50}}',
        '{"bag_resp":{"ret_code":1e10}}',
        '{"bag_resp":{"ret_code":123456789012345678901234567890}}',
    ]
    res = run(spark, docs)
    assert res[0]["ret_code"] is None and res[0]["error_msg"] == "e"
    assert res[1]["ret_code"] == '{"a":1}'
    assert [r["ret_code"] for r in res[2:]] == ["5", "true", "007", "1.5", "1.0E10", "123456789012345678901234567890"]


def test_j8_j9_first_element(spark):
    base = '{"bag_resp":{"resp_info":%s}}'
    docs = [
        "{}",  # resp_info missing
        base % "[]",
        base % "{}",
        base % "[null]",
        base % '["x"]',
        base % '"x"',
        base % '[{"storage_loc":"L1"}]',
        base % '[{"storage_loc":"L2"}, 5]',
    ]
    res = run(spark, docs)
    assert kept(res) == [True, False, False, False, False, False, True, True]
    assert res[6]["resp_info_storage_loc"] == "L1"
    assert res[7]["resp_info_storage_loc"] == "L2"


def _itin(value):
    return '{"bag_resp":{"resp_info":[{"curr_itin":{"flt_info":%s}}]}}' % value


def test_j10_j11_legs(spark):
    ok = ['{"bag_resp":{"resp_info":[{"curr_itin":{}}]}}', _itin("[]"), _itin("{}"), _itin('""')]
    bad = [_itin(v) for v in ['{"a":1}', '"x"', "null", "5", "true", "[null]", '[{},"x"]', '[{},{},{},{},5]']]
    res = run(spark, ok + bad)
    assert kept(res) == [True] * 4 + [False] * len(bad)
    for r in res[:4]:
        assert all(r[f"resp_curritnr_{i}_flt_nbr"] is None for i in range(5))


def test_j12_more_than_five_legs(spark):
    legs = [{"flt_nbr": i} for i in range(6)] + ["x"]
    (r,) = run(spark, [_itin(json.dumps(legs))])
    assert r is not None
    assert [r[f"resp_curritnr_{i}_flt_nbr"] for i in range(5)] == ["0", "1", "2", "3", "4"]
    assert "resp_curritnr_5_flt_nbr" not in r


def test_j13_duplicate_key_last_wins(spark):
    (r,) = run(spark, ['{"bag_resp":{"ret_code":"a","ret_code":"b"}}'])
    assert r["ret_code"] == "b"


def test_j14_j15_trailing_space_key(spark):
    no_space = '{"bag_resp":{"resp_info":[{"br_trans_res":{"scanned_flt_info":{"flt_info":{"flt_nbr":"1"}}}}]}}'
    space = '{"bag_resp":{"resp_info":[{"br_trans_res":{"scanned_flt_info":{"flt_info ":{"flt_nbr":"2"}}}}]}}'
    a, b = run(spark, [no_space, space])
    assert a["br_trans_res_flt_info_flt_nbr"] is None
    assert b["br_trans_res_flt_info_flt_nbr"] == "2"


def test_j16_j17_bm_rules(spark):
    docs = [
        '{"bagResp":{"bagRespInfo":{"missingBagSummaryBySector":{"totalTransferBags":"3"}}}}',
        '{"bagResp":{"bagRespInfo":{"missingBagSummaryBySector":{"totalTransferBags":{"tbBysector":{"count":1}}}}}}',
        '{"bagResp":{"bagRespInfo":{"flightInfo":[{"carrierCode":"AA"}]}}}',
        '{"bagResp":{"bagRespInfo":{"flightInfo":{"carrierCode":"AA"}}}}',
    ]
    res = run(spark, docs, spec=BM)
    assert kept(res) == [False, True, False, True]
    assert res[1]["totalTransferBags"] == '{"tbBysector":{"count":1}}'
    assert res[1]["missingBagSummaryBySector_tbBysector_count"] == "1"
    assert res[3]["bagRespInfo_carrierCode"] == "AA"
    assert list(res[1].keys()) == BM.columns()


def test_j18_table_keys_win(spark):
    (r,) = run(spark, ['{"pk":"payload-pk","bag_resp":{}}'])
    assert r["pk"] == "p0"


def test_lenient_keeps_wrong_kind_nodes(spark):
    docs = ['{"bag_resp":null}', '{"bag_resp":{"ret_code":1,"resp_info":[]}}', "nope"]
    res = run(spark, docs, strict=False)
    assert kept(res) == [True, True, False]
    assert res[1]["ret_code"] == "1"


def test_rejects_reason(spark):
    rows = [("p0", "s", None, "t"), ("p1", "s", "nope", "t"), ("p2", "s", "[1]", "t"),
            ("p3", "s", '{"bag_resp":null}', "t"), ("p4", "s", "{}", "t")]
    df = spark.createDataFrame(rows, "pk string, sk string, scanResponse string, upsertTimestamp string")
    got = {r.pk: r.reject_reason for r in json_rejects(df, "scanResponse", SCAN).collect()}
    assert got == {"p0": "null_payload", "p1": "malformed", "p2": "not_object", "p3": "node:bag_resp"}


def test_k4_corrected_key_option(spark):
    from unfurl.plans.catalog import SCAN as S

    old = "bag_resp/resp_info[0]/br_trans_res/scanned_flt_info/flt_info "
    fixed = S.with_path(old, old.rstrip())
    assert fixed.columns() == S.columns()
    doc = '{"bag_resp":{"resp_info":[{"br_trans_res":{"scanned_flt_info":{"flt_info":{"flt_nbr":"1"}}}}]}}'
    (r,) = run(spark, [doc], spec=fixed)
    assert r["br_trans_res_flt_info_flt_nbr"] == "1"


def test_keys_match_case_sensitively(spark):
    (r,) = run(spark, ['{"bag_resp":{"RET_CODE":"x","error_msg":"e"}}'])
    assert r["ret_code"] is None and r["error_msg"] == "e"


def test_pretty_printed_json_with_unicode(spark):
    doc = '\n{\n  "bag_resp": {\n    "ret_code": "0",\n    "error_msg": "café ✓",\n    "hdr": {"stn_cd": "ÅRH"}\n  }\n}\n'
    (r,) = run(spark, [doc])
    assert (r["ret_code"], r["error_msg"], r["stn_cd"]) == ("0", "café ✓", "ÅRH")

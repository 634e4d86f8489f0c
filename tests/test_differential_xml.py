"""Random XML documents: native flatten vs the independent per-row model."""

import json
import random

import pytest

from pyoracle import flatten_xml_py
from unfurl import BM_XML, CEP_XML, flatten_xml


def _text(rnd):
    return rnd.choice(["A1", " pad ", "x &amp; y", "", "007", "é", "1 &lt; 2"])


def _leaves(rnd, fields):
    out = []
    for f in fields:
        r = rnd.random()
        if r < 0.55:
            out.append(f"<{f}>{_text(rnd)}</{f}>")
        elif r < 0.6:
            out.append(f"<{f}/>")
        elif r < 0.63:
            out.append(f"<{f}>a</{f}><{f}>b</{f}>")
    return "".join(out)


def _el(rnd, name, body, p_bad):
    r = rnd.random()
    if r < p_bad:
        return rnd.choice([f"<{name}/>", f"<{name}>t</{name}>", f'<{name} k="1"/>', f"<{name}>{body}</{name}>" * 2])
    return f"<{name}>{body or '<other>1</other>'}</{name}>"


def _doc(rnd, spec):
    g = {gr.path: gr for gr in spec.groups}
    ns = rnd.random() < 0.3
    hdr_fields = g["Envelope/eventHeader"].fields
    attr = ' version="A"' if rnd.random() < 0.1 else ""
    hdr = f"<eventHeader{attr}>{_leaves(rnd, hdr_fields)}</eventHeader>" if rnd.random() < 0.9 else ""
    d = "Envelope/Body/bagDetails"
    parts = [_leaves(rnd, g[d].fields)]
    info = _leaves(rnd, g[f"{d}/bagInfo"].fields)
    if f"{d}/bagInfo/tagBagType" in g and rnd.random() < 0.7:
        info += _el(rnd, "tagBagType", _leaves(rnd, ("BagTypeCd", "Priority")), 0.05)
    if rnd.random() < 0.9:
        parts.append(_el(rnd, "bagInfo", info, 0.04))
    if rnd.random() < 0.9:
        parts.append(_el(rnd, "paxInfo", _leaves(rnd, g[f"{d}/paxInfo"].fields), 0.04))
    r = rnd.random()
    if r < 0.3:
        parts.append("<bagScans>" + rnd.choice(["<bagScanDtl/>", "<bagScanDtl><fltNbr>1</fltNbr></bagScanDtl>",
                                                 "<bagScanDtl> </bagScanDtl>", "<bagScanDtl><a>1</a></bagScanDtl>" * 2])
                     + "</bagScans>")
    for wrapper, path in (("bagCurrentItineraries", f"{d}/bagCurrentItineraries/bagItineraryDtl"),
                          ("bagOriginalItineraries", f"{d}/bagOriginalItineraries/bagItineraryDtl")):
        if rnd.random() < 0.8:
            n = rnd.choice([0, 1, 2, 2, 3])
            legs = "".join(f"<bagItineraryDtl>{_leaves(rnd, g[path].fields) or '<x>1</x>'}</bagItineraryDtl>"
                           for _ in range(n))
            if n >= 2 and rnd.random() < 0.1:
                legs = "<bagItineraryDtl/>" + legs
            parts.append(f"<{wrapper}>{legs or '<none>1</none>'}</{wrapper}>")
    body = f"<Body><bagDetails>{''.join(parts)}</bagDetails></Body>"
    # a default namespace on some documents: tags are matched without it
    xml = f'<Envelope xmlns="urn:d">{hdr}{body}</Envelope>' if ns else f"<Envelope>{hdr}{body}</Envelope>"
    xml = rnd.choice([str] * 12 + [
        lambda x: x.replace("<eventName>", "<q:eventName>").replace("</eventName>", "</q:eventName>"),  # no such prefix
        lambda x: x.replace("<eventName>", '<q:eventName xmlns:q="urn:q">').replace("</eventName>", "</q:eventName>"),
        lambda x: x.replace("<Envelope", '<Envelope xmlns:q="urn:q"', 1).replace("<Body>", "<q:Body>").replace("</Body>", "</q:Body>"),
        lambda x: '<!DOCTYPE Envelope [<!ENTITY e "E&#33;">]>' + x.replace("A1", "&e;"),
        lambda x: x.replace("tagNbr>", "TAGNBR>").replace("paxInfo>", "PaxInfo>"),
        lambda x: x.replace("<bagDetails>", '<bagDetails TAGNBR="9" q="x:y z:w=1">'),
        lambda x: x.replace("<eventHeader>", '<eventHeader xmlns:n="urn:n" n:version="7" n:EventName="8">'),
    ])(xml)
    r = rnd.random()
    if r < 0.03:
        xml = xml[:-3]
    elif r < 0.05:
        xml = "<Other><a>1</a></Other>"
    elif r < 0.06:
        xml = xml + " tail"
    return json.dumps({"text": xml}, ensure_ascii=False)


@pytest.mark.parametrize("spec,seed", [(CEP_XML, 3), (BM_XML, 4)])
def test_random_xml_documents_match_model(spark, spec, seed):
    rnd = random.Random(seed)
    docs = [_doc(rnd, spec) for _ in range(300)]
    rows = [(f"p{i}", "s", d, "t") for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "pk string, sk string, payload string, upsertTimestamp string")
    got = {r["pk"]: r.asDict() for r in flatten_xml(df, "payload", spec).collect()}
    kept = dropped = 0
    for i, d in enumerate(docs):
        want = flatten_xml_py(d, spec)
        have = got.get(f"p{i}")
        assert (want is None) == (have is None), f"row {i} kept mismatch: {d[:400]}"
        if want is None:
            dropped += 1
            continue
        kept += 1
        for col in spec.payload_columns():
            assert have[col] == want[col], f"row {i} column {col}: {have[col]!r} != {want[col]!r}\n{d[:400]}"
    assert kept > 40 and dropped > 20


@pytest.mark.parametrize("spec,seed", [(CEP_XML, 7), (BM_XML, 8)])
def test_random_xml_documents_match_model_lenient(spark, spec, seed):
    rnd = random.Random(seed)
    docs = [_doc(rnd, spec) for _ in range(300)]
    rows = [(f"p{i}", "s", d, "t") for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "pk string, sk string, payload string, upsertTimestamp string")
    got = {r["pk"]: r.asDict() for r in flatten_xml(df, "payload", spec, strict=False).collect()}
    for i, d in enumerate(docs):
        want = flatten_xml_py(d, spec, strict=False)
        have = got.get(f"p{i}")
        assert (want is None) == (have is None), f"row {i} kept mismatch: {d[:400]}"
        if want is not None:
            for col in spec.payload_columns():
                assert have[col] == want[col], f"row {i} column {col}: {have[col]!r} != {want[col]!r}\n{d[:400]}"


def test_xml_rejects_are_exactly_the_dropped_rows(spark):
    from unfurl import xml_rejects

    rnd = random.Random(10)
    docs = [_doc(rnd, CEP_XML) for _ in range(300)]
    rows = [(f"p{i}", "s", d, "t") for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "pk string, sk string, payload string, upsertTimestamp string")
    kept = {r.pk for r in flatten_xml(df, "payload", CEP_XML).select("pk").collect()}
    rejected = {r.pk for r in xml_rejects(df, "payload", CEP_XML).collect()}
    assert kept.isdisjoint(rejected)
    assert kept | rejected == {f"p{i}" for i in range(len(docs))}

"""XML payloads whose wrapper holds one string alone: its text is taken without a parse of the whole wrapper."""

from unfurl import flatten_xml
from unfurl.functions import variant as V
from unfurl.plans.spec import FlattenSpec, Group


def test_payloads_with_one_string_are_not_parsed_twice(spark):
    xml = "<Envelope><Body><tagNbr>1 \\u00e9 \\\" \\/</tagNbr></Body></Envelope>"
    docs = {
        "alone": (f'{{"text":"{xml}"}}', True, True), "blanks": (f' {{ "text" :\n"{xml}" }} ', True, True),
        "more": (f'{{"text":"{xml}","n":1}}', False, True), "twice": (f'{{"text":"x","text":"{xml}"}}', False, True),
        "tail": (f'{{"text":"{xml}"}} x', False, False), "number": ('{"text":1}', False, False), "null": ('{"text":null}', False, False),
        "closed": (f'{{"text":"{xml}"}}]', False, False), "control": ('{"text":"<Envelope>\t</Envelope>"}', False, False), "escape": ('{"text":"\\x"}', False, False),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in docs.items()], "pk string, doc string")
    only = {r.pk: r.one for r in df.selectExpr("pk", f"{V.only_member('doc', 'text')} AS one").collect()}
    assert {k: v is not None for k, v in only.items()} == {k: v[1] for k, v in docs.items()}
    assert only["alone"] == '<Envelope><Body><tagNbr>1 é " /</tagNbr></Body></Envelope>'
    rows = {r.pk: r.tagNbr for r in flatten_xml(df, "doc", FlattenSpec("one", (Group("Envelope/Body", ("tagNbr",)),), key_columns=("pk",))).collect()}
    assert rows == {k: '1 é " /' for k, v in docs.items() if v[2]}

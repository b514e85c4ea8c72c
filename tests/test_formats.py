import pytest

from millrace.operators import canonical as can
from millrace.operators.detect import DEFAULT_RULES, DetectionRule, detect_format
from millrace.operators.formats import FORMATS_WITH_GENERIC_IDS, FORMATS

HL7 = ("MSH|^~\\&|WARDSYS|NORTHGATE|EVENTLAKE|CENTRAL|202604170915||ADT^A08|M-7781|T|2.5\rEVN|A08|202604170914\r"
       "PID|1||K-4410^^^NG^PI||Okafor^Lena^R||19790212|F\rPV1|1|O|CLINIC^4^B" + "|" * 17 + "V-902")
X12 = ("ISA*00*          *00*          *ZZ*CLINICA*ZZ*PAYER7*260417*0915*^*00501*000000731*0*P*:~GS*HC*CLINICA*PAYER7*20260417*0915*31*X*005010X222A1~"
       "ST*837*0731~BHT*0019*00*731*20260417*0915*CH~NM1*IL*1*Okafor*Lena****MI*K-4410~CLM*V-902*412.5***22:B:1*Y*A*Y*Y~DTP*472*D8*20260416~SE*7*0731~")


def run(spark, payloads, **options):
    rows = [(i, f"e{i}", "src", p) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "msg_id int, event_id string, source_system string, payload string")
    return sorted(can.canonicalize(df, **options).collect(), key=lambda r: r["msg_id"])


@pytest.mark.parametrize("rules,payload,expected", [
    (DEFAULT_RULES, HL7, "hl7"),
    (DEFAULT_RULES, X12, "x12"),
    (DEFAULT_RULES, '{"entry":[{"resource":{"resourceType":"Encounter"}}]}', "fhir"),
    (DEFAULT_RULES, '{"note":"MSH|"}', "generic"),
    (DEFAULT_RULES, "", "generic"),
    ((), HL7, "generic"),
    # A key counts only in text that is JSON, and a later rule only if no earlier one holds.
    ((DetectionRule("keyed", "lab", contains_key="panel"),), '{"panel":', "generic"),
    ((DetectionRule("keyed", "lab", contains_key="panel"),), '{"order":{"panel":null}}', "lab"),
    ((DetectionRule("first", "a", prefix="{"), DetectionRule("second", "b", contains_key="panel")), '{"panel":1}', "a"),
    ((DetectionRule("either", "c", prefix="#!", contains_key="panel"),), "#! panel", "c"),
])
def test_detection(spark, rules, payload, expected):
    df = spark.createDataFrame([(payload,)], "payload string")
    assert detect_format(df, rules).first()["format"] == expected


def test_hl7_message(spark):
    (row,) = run(spark, [HL7])
    assert row["error_reason"] is None
    assert row["fields"]["msh.message_type"] == "ADT^A08"
    assert row["patient"].asDict() == {"id": "K-4410^^^NG^PI", "first_name": "Lena", "last_name": "Okafor"}
    assert row["encounter"].asDict() == {"id": "V-902", "type": "O"}
    assert row["observation"]["code"] == "ADT^A08"
    assert row["metadata"] == {"event_id": "e0", "source_system": "src"}
    assert (row["entity_type"], row["entity_id"]) == ("patient", "K-4410")


@pytest.mark.parametrize("payload,reason", [
    (HL7.replace("PID|", "NK1|"), "missing PID segment"),
    (HL7.replace("PV1|", "ZV1|"), "missing PV1 segment"),
    (HL7.replace("\r", "\r\n"), None),
    ("MSH|^~\\&|WARDSYS", "missing PID segment"),
])
def test_hl7_required_segments(spark, payload, reason):
    (row,) = run(spark, [payload])
    assert row["error_reason"] == reason
    assert row["error_stage"] == ("normalize" if reason else None)


def test_hl7_last_segment_wins_and_missing_fields_are_empty(spark):
    (row,) = run(spark, ["MSH|a\nPID|1||first\nPIDX|1||no\nPID|2||last\n  PV1|1  \n\n"])
    assert row["patient"].asDict() == {"id": "last", "first_name": "", "last_name": ""}
    assert row["encounter"].asDict() == {"id": "", "type": ""}
    assert row["observation"]["code"] == ""


def test_hl7_rule_key_is_the_first_component(spark):
    (row,) = run(spark, ["MSH|a\nPID|1||123^^^HOSP^MR||D^J\nPV1|1"])
    assert row["patient"]["id"] == "123^^^HOSP^MR" and row["entity_id"] == "123"


def test_x12_message(spark):
    (row,) = run(spark, [X12])
    assert row["patient"].asDict() == {"id": "K-4410", "first_name": "Lena", "last_name": "Okafor"}
    assert row["encounter"]["id"] == "V-902"
    assert row["observation"]["code"] == "837"
    assert row["fields"]["dtp.service_date"] == "20260416"
    assert row["fields"]["gs.raw"].startswith('["GS","HC"')


def without(segment):
    """The claim without the segment that starts so."""
    return "~".join(x for x in X12.split("~") if not x.startswith(segment))


@pytest.mark.parametrize("payload,reason", [
    (without("GS"), "x12: missing GS segment"),
    (without("ST"), "x12: missing ST segment"),
    (without("NM1*IL"), "x12: missing NM1*IL patient segment"),
    (without("CLM"), "x12: missing CLM segment"),
    (X12.replace("~", "~\n"), None),
])
def test_x12_required_segments(spark, payload, reason):
    (row,) = run(spark, [payload])
    assert row["error_reason"] == reason


def test_x12_short_name_segment_gives_empty_identifiers(spark):
    (row,) = run(spark, ["ISA*0~GS*H~ST*837~NM1*IL*1*Doe*John~CLM*77~"])
    assert row["patient"].asDict() == {"id": "", "first_name": "", "last_name": ""}
    assert (row["entity_type"], row["entity_id"]) == ("encounter", "77")


def test_fhir_resources(spark):
    rows = run(spark, [
        '{"resourceType":"Patient","id":"p1","meta":{"profile":["u"]}}',
        '{"resourceType":"Encounter","id":"e1","class":{"code":"AMB"}}',
        '{"resourceType":"Observation","id":"o1","code":{"coding":[{"code":"718-7"}]},"valueQuantity":{"value":13.5}}',
        '{"resourceType":"Claim","id":"c1"}',
        '{"wrap":{"resourceType":"Patient"}}',
        '{"resourceType":5}',
        '[{"resourceType":"Patient"}]',
        '{"resourceType":"Observation","code":{"coding":[]}}',
        '{"resourceType":"Patient","id":7}',
    ])
    assert rows[0]["patient"]["id"] == "p1" and rows[0]["metadata"] == {"meta.profile": '["u"]'}
    assert rows[1]["encounter"].asDict() == {"id": "e1", "type": "AMB"}
    assert rows[2]["observation"].asDict() == {"code": "718-7", "value": "13.5"}
    assert [r["error_reason"] for r in rows[3:7]] == [
        "unsupported resourceType: Claim", "missing resourceType", "missing resourceType", "invalid fhir json: expected object"]
    assert rows[7]["error_reason"] == "derive_failed"
    assert rows[8]["patient"]["id"] == "" and rows[8]["error_reason"] == "derive_failed"


def test_generic_is_kept_whole_but_has_no_identifiers(spark):
    text = '{"encounter_id":"1","member_id":"Q-20-55"}'
    (row,) = run(spark, [text])
    assert row["fields"] == {"raw": text} and row["error_reason"] == "missing_identifiers"
    (row,) = run(spark, [text], formats=FORMATS_WITH_GENERIC_IDS)
    assert row["patient"]["id"] == "Q-20-55" and row["encounter"]["id"] == "1" and row["error_reason"] is None


def test_null_payload_is_rejected(spark):
    (row,) = run(spark, [None])
    assert row["error_reason"] == "nil raw payload"


def test_unknown_format_has_no_normalizer(spark):
    (row,) = run(spark, ["Q|1"], rules=(DetectionRule("q", "q", prefix="Q|"),))
    assert row["error_reason"] == "no normalizer for format: q" and row["error_stage"] == "normalize"


def test_canonicalize_is_one_pass_without_shuffle_or_python(spark):
    df = spark.createDataFrame([(1, "e", "s", HL7)], "msg_id int, event_id string, source_system string, payload string")
    plan = can.canonicalize(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan


def test_filters_do_not_repeat_the_parsing(spark):
    df = spark.createDataFrame([(1, "e", "s", HL7)], "msg_id int, event_id string, source_system string, payload string")
    plan = can.canonicalize(df).filter("format = 'hl7' AND error_reason IS NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") <= 1


def test_every_format_is_registered_once():
    assert [s.name for s in FORMATS] == ["hl7", "x12", "fhir", "generic"]

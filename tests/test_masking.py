"""Masking of values inside JSON and HL7 text."""

import json

import pytest

from millrace.functions import masking

KEYS = frozenset(("address", "phone", "dob"))


def masked(text, keys=KEYS, codes=frozenset()):
    return masking._masked(text, keys, codes)


@pytest.mark.parametrize("text, want", [
    ('{"address": {"street": "1 Hill Rd", "city": "Y"}, "k": 1}', '{"address":"***","k":1}'),
    ('{"phone":["1","2"],"k":[{"dob":{"y":1}}]}', '{"phone":"***","k":[{"dob":"***"}]}'),
    ('{"dob":null,"phone":false,"address":0}', '{"dob":null,"phone":"***","address":"***"}'),
    ('{"n":1.10,"e":1e5,"big":123456789012345678901234567890}', '{"n":1.10,"e":1e5,"big":123456789012345678901234567890}'),
    ('{"q":"\\"dob\\":1 \\ue0001.5\\ue000","x":2.50}', None),
    ('"dob"', '"dob"'), ("[]", "[]"),
])
def test_values_of_named_keys(text, want):
    got = masked(text)
    if want is not None:
        assert got == want
    else:
        assert json.loads(got) == json.loads(text)


@pytest.mark.parametrize("text", ["", "{", '{"dob":1} x', "[" * 100_000 + "]" * 100_000, "{'dob':1}"])
def test_text_that_is_not_json_is_not_passed_on(text):
    assert masked(text) is None


def test_lab_values_by_code():
    text = '{"a":[{"lab_value":5.50,"lab_code":"X1"},{"lab_code":"X2","lab_value":7},{"lab_code":3,"lab_value":1}]}'
    assert masked(text, frozenset(), frozenset(("X1",))) == '{"a":[{"lab_value":"***","lab_code":"X1"},{"lab_code":"X2","lab_value":7},{"lab_code":3,"lab_value":1}]}'


def test_obx_segments(one):
    texts = ["OBX|1|NM|X.1^N||5|mg\rOBX|2|NM|XA1||6|mg\r\n OBX|3|NM|X.1||7", "PID|1||OBX|x", None]
    got = one(texts, lambda c: masking.mask_obx(c, ("X.1",)))
    assert got == ["OBX|1|NM|X.1^N||***|mg\rOBX|2|NM|XA1||6|mg\r\n OBX|3|NM|X.1||***", "PID|1||OBX|x", None]


def test_json_column(one):
    assert one(['{"dob":1}', "no", None], lambda c: masking.mask_json(c, ("dob",))) == ['{"dob":"***"}', None, None]

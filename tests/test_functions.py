from __future__ import annotations

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import model
from deskwright.functions import formatting, keys, masking, text
from deskwright.functions.timestamps import parse_timestamp

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def apply(spark, function, values, dtype="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r["r"] for r in rows.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()]


def iso_texts(count: int) -> list[str]:
    rng = random.Random(11)
    dates = ["2025-12-31", "2024-02-29", "2025-02-29", "0001-01-01", "9999-12-31", "0000-01-01",
             "20251231", "2025-W01-1", "2025-W53", "2020-W53-7", "2020W531", "2025", "2025-1-5"]
    clocks = ["", "T", "T10", "T10:00", "T10:00:59", " 23:59:59.1", "T10:00:00,5", "x24:00",
              "T10:00:00.1234567", "T1000", "T100059.25", "T10:60", "t10:00:00.", "T9:00"]
    offsets = ["", "Z", "z", "+00:00", "-05:30", "+0530", "+05", "+23:59", "+24:00", " Z", "UTC",
               "+05:30:15.5", "x+02:00", " Europe/Paris", "-17:59", "+18:30"]
    made = {
        rng.choice(dates) + rng.choice(clocks) + rng.choice(offsets) + rng.choice(["", " ", "\t"])
        for _ in range(count)
    }
    return sorted(made | {"now", "today", "epoch", "", "T10:00", "a|b", "not-a-date"})


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_follow_the_iso_grammar_in_any_session_zone(spark, zone):
    values = iso_texts(4_000)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = apply(spark, lambda c: F.unix_micros(parse_timestamp(c)), values)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for value, micros in zip(values, got):
        expected = model.instant(value)
        wanted = None if expected is None else (expected - EPOCH) // timedelta(microseconds=1)
        assert micros == wanted, value


def test_casefold_and_strip_equal_unicode_rules(spark):
    letters = [chr(i) for i in range(1, 0x110000) if not 0xD800 <= i <= 0xDFFF]
    values = letters[:0x3000] + letters[0xA000:0xC000] + letters[0xF900:0x11000]
    values += ["STRAẞE İIıſ ΑΣ ας", "Ünï@EXAMPLE.com"]
    assert apply(spark, text.casefold, values) == [v.casefold() for v in values]
    assert apply(spark, text.strip, values) == [v.strip() for v in values]


def test_clean_text_collapses_unicode_whitespace(spark):
    values = [None, "", "  a  b ", "a  b", "\x1ca\n\tb\x85", "plain text", "a​b"]
    assert apply(spark, text.clean_text, values) == [model.clean(v) for v in values]


def test_mask_email_is_stable_and_hides_the_address(spark):
    values = ["Person@Example.invalid", " person@example.invalid ", "", "ÄB@x.de"]
    first, second, empty, other = apply(spark, masking.mask_email, values)
    assert first == second == model.alias("person@example.invalid")
    assert empty == "e3b0c44298fc1c14@masked.invalid"
    assert other == model.alias("äb@x.de")


def random_texts(count: int) -> list[str]:
    rng = random.Random(5)
    pieces = ["a@b.cc", "User.Name+x@Mail.example.org", "@", ".", "+1-202-555-0100", "12345678",
              "1234567890", "(202) 555 0199", " ", "  ", "é", "ß", "_", "-", "٣٤٥٦٧٨٩٠١٢", "x@y",
              "a@b.c", "a@b.cc1", "ü@b.cc", "%a@b-c.dd", "K", "\n", ",", "SD-000000001"]
    return ["".join(rng.choices(pieces, k=rng.randint(1, 9))) for _ in range(count)]


def test_mask_text_equals_plain_regular_expressions(spark):
    values = random_texts(4_000) + ["2025-12-31 10:00:00+00:00", "2025-12-31T10:00:00Z"]
    assert apply(spark, masking.mask_text, values) == [model.mask(v) for v in values]


def test_alias_of_only_digits_is_masked_again(spark):
    address = next(
        a for a in (f"user{i}@example.invalid" for i in range(100_000))
        if model.alias(a)[:16].isdigit()
    )
    assert apply(spark, masking.mask_text, [address]) == ["[PHONE]@masked.invalid"]


def test_mask_json_handles_any_depth(spark):
    document = {
        "owner": "user@example.invalid",
        "n": 3,
        "ok": True,
        "none": None,
        "Phone": 2025550199,
        "deep": {"deeper": {"deepest": {"email": "a@b.cc", "note": "call 202-555-0199"}}},
        "list": ["a@b.cc", {"mobile": "1"}],
    }
    lines = [json.dumps(document), None, "not json, a@b.cc"]
    masked, none, raw = apply(spark, lambda c: masking.mask_json()(c), lines)
    result = json.loads(masked)
    assert result["owner"] == model.alias("user@example.invalid")
    assert (result["n"], result["ok"], result["none"]) == (3, True, None)
    assert result["Phone"] == "[REDACTED]"
    assert result["deep"]["deeper"]["deepest"] == {
        "email": model.alias("a@b.cc"),
        "note": "call [PHONE]",
    }
    assert result["list"] == [model.alias("a@b.cc"), {"mobile": "[REDACTED]"}]
    assert none is None
    assert json.loads(raw) == {"raw": "not json, " + model.alias("a@b.cc")}
    kept = apply(spark, lambda c: masking.mask_json(mask_lists=False)(c), lines[:1])[0]
    assert json.loads(kept)["list"] == document["list"]


def test_keys_and_formats(spark):
    row = spark.range(1).select(
        keys.ticket_key(F.lit("a:b"), F.lit("c")).alias("k1"),
        keys.ticket_key(F.lit("a"), F.lit("b:c")).alias("k2"),
        keys.run_key(F.lit("h"), F.lit("c"), F.lit(True), F.lit(False)).alias("run"),
        formatting.percent(F.lit(0.98052)).alias("percent"),
        formatting.thousands(F.lit(1234567)).alias("thousands"),
    ).first()
    assert row["k1"] == row["k2"]
    assert row["run"] == keys.run_key_of("h", "c", True, False)
    assert (row["percent"], row["thousands"]) == ("98.05%", "1,234,567")


def test_maps_of_any_value_type_hide_sensitive_keys(spark):
    rows = spark.sql(
        "SELECT map('phone', 12025550100L, 'count', 3L) AS numbers, "
        "map('Email', named_struct('at', 'a@b.example'), 'x', named_struct('at', 'c@d.example')) AS nested, "
        "map('phone', '+1-202-555-0100', 'note', 'ok') AS texts"
    )
    masked = [
        masking.mask_value(F.col(f.name), f.dataType).alias(f.name) for f in rows.schema.fields
    ]
    found = json.loads(rows.select(masking.to_payload(F.struct(*masked)).alias("p")).first()["p"])
    assert found["numbers"] == {"phone": "[REDACTED]", "count": 3}
    assert found["nested"]["Email"] == model.alias('{"at":"a@b.example"}')
    assert found["nested"]["x"] == {"at": model.alias("c@d.example")}
    assert found["texts"] == {"phone": "[REDACTED]", "note": "ok"}

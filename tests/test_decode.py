"""Decode and quarantine cases (FIXTURES §1)."""

from cartwheel.operators import decode

from helpers import event, wire


def _decoded(spark, payloads):
    return decode.decode_events(wire(spark, payloads))


def test_valid_events_and_timestamp_shapes(spark):
    df = _decoded(spark, [
        event("e1"),
        event("e2", ts="2024-01-15T10:00:00+00:00"),
        event("e3", category=None),
    ])
    valid, bad = decode.validate(df)
    rows = {r.event_id: r for r in valid.collect()}
    assert set(rows) == {"e1", "e2", "e3"} and bad.count() == 0
    assert rows["e1"].event_time.microsecond == 123456
    assert rows["e2"].event_time.second == 0 and rows["e2"].event_time.hour == 10
    assert rows["e3"].category is None


def test_quarantine_reasons(spark):
    df = _decoded(spark, [
        "garbage",
        None,
        event("bad-ts", ts="yesterday"),
        event("bad-type", etype="signup"),
        event("no-product", product=None),
        event("x" * 65),
    ])
    valid, bad = decode.validate(df)
    assert valid.count() == 0
    reasons = [(r.event_id, r.reason) for r in bad.collect()]
    by_id = dict(reasons)
    assert by_id["bad-ts"] == "bad_event_time"
    assert by_id["bad-type"] == "bad_event_type"
    assert by_id["no-product"] == "missing_product_id"
    assert by_id["x" * 65] == "too_long_event_id"
    missing_all = [r for i, r in reasons if i is None]
    assert len(missing_all) == 2  # garbage text and NULL value
    for r in missing_all:
        assert r.startswith("missing_event_id,missing_user_id,missing_product_id,missing_event_type")
        assert "bad_event_time" in r


def test_raw_projection_keeps_six_fields(spark):
    df = _decoded(spark, [event("e1")])
    out = decode.raw_projection(df)
    assert out.columns == ["event_id", "user_id", "product_id", "category", "event_type",
                           "event_time", "ingested_at"]


def test_wide_raw_projection_keeps_session_fields(spark):
    from cartwheel.operators import decode

    valid, _ = decode.validate(decode.decode_events(wire(spark, [event("w1")])))
    narrow = decode.raw_projection(valid)
    wide = decode.raw_projection(valid, wide=True)
    assert "session_id" not in narrow.columns
    row = wide.first()
    assert (row.session_id, row.device, row.referrer) == ("s-1", "mobile", "organic")
    assert row.kafka_timestamp is not None and row.ingested_at is not None

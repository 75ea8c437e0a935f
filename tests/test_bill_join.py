"""Events and bills are joined without sending either to every task."""

from upswell.plans import pool


def test_bills_are_not_sent_to_every_task(spark):
    """What is read out of VARIANT looks far smaller than it is: lists of acts in particular."""
    lines = spark.range(300).selectExpr("parse_json(concat('{\"id\": \"', id, '\", \"city\": \"c\"}')) AS raw")
    events = lines.selectExpr("variant_get(raw, '$.id', 'bigint') AS event_id", "variant_get(raw, '$.city', 'string') AS city")
    bill = lines.selectExpr("variant_get(raw, '$.id', 'bigint') AS event_id", "0 AS billing_order", "'act' AS performer_name", "'m' AS performer_mbid")
    found = pool.billed_performers(bill, events)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [event_id" in plan and "BroadcastHashJoin" not in plan
    assert [(r.artist_key, r.source, r.position.event_id) for r in found.collect()] == [("mbid:m", "event:c", 0)]

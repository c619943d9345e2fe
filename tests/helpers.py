import datetime as dt

from mqtable.schema import MESSAGE_SCHEMA

T0 = dt.datetime(2024, 1, 1)


def messages(spark, rows):
    """rows: dicts with any MESSAGE_SCHEMA fields; the rest get defaults."""
    out = []
    for i, r in enumerate(rows):
        base = {
            "message_id": i,
            "queue": "q",
            "delivery_tag": i + 1,
            "exchange": "ex",
            "routing_key": "",
            "body": "{}",
            "headers": None,
            "priority": None,
            "fail_count": 0,
            "published_at": T0 + dt.timedelta(seconds=i),
        }
        base.update(r)
        if isinstance(base["body"], str):
            base["body"] = base["body"].encode()
        out.append(tuple(base[f.name] for f in MESSAGE_SCHEMA.fields))
    return spark.createDataFrame(out, MESSAGE_SCHEMA)

"""Small messages and a one-message-at-a-time version filter to compare with."""

import datetime
import json

from tidelog.options import IngestOptions
from tidelog.schemas import TOPIC_RECORD

START = datetime.datetime(2026, 5, 16, 12, 0, 0)
PROPERTIES = {
    "name": "sink-stations",
    "topics": "plant-stations",
    "iceberg.tables.dynamic-enabled": "true",
    "iceberg.tables.route-field": "iceberg_table",
    "iceberg.tables.default-id-columns": "dedup_key",
    "iceberg.tables.cdc-field": "_cdc_op",
    "iceberg.catalog.type": "hive",
    "transforms.customCdc.topic.table.map": "plant-stations:def.abc",
}
# Nine messages in three batches, and the rows they leave.
GOLDEN = [
    [((1, 2), "INSERT", 1), ((3,), "INSERT", 1), ((5, 6), "INSERT", 1)],
    [((1, 2), "UPDATE", 2), ((3,), "DELETE", 2), ((5, 6), "UPDATE", 2)],
    [((3,), "INSERT", 1), ((1, 2), "UPDATE", 1), ((7, 8), "INSERT", 1)],
]
GOLDEN_ROWS = [
    ("TRAM001||TRAM002", "UPDATE", 2),
    ("TRAM003", "INSERT", 1),
    ("TRAM005||TRAM006", "UPDATE", 2),
    ("TRAM007||TRAM008", "INSERT", 1),
]


def options(**more) -> IngestOptions:
    return IngestOptions.from_properties({**PROPERTIES, **more})


def message(stations, change_type, version, **more) -> str:
    # Station names are written unsorted on purpose; the key has to come out sorted.
    items = [{"MaTram": f"TRAM{n:03d}", "TenTram": "Trạm Hà Nội", "KinhDo": 105.8} for n in reversed(stations)]
    body = {"data": items, "length": len(items), "key": "MaTram", "type": change_type, "version": version,
            "ngay_cap_nhat": "16/05/2026-12:00", **more}
    return json.dumps({k: v for k, v in body.items() if v is not ...}, ensure_ascii=False)


def records(spark, values, topic="plant-stations", first=0, partition=0):
    rows = [(topic, partition, first + i, START + datetime.timedelta(seconds=first + i), None, value)
            for i, value in enumerate(values)]
    return spark.createDataFrame(rows, TOPIC_RECORD)


def golden_records(spark, batch):
    first = sum(len(b) for b in GOLDEN[:batch])
    return records(spark, [message(*m) for m in GOLDEN[batch]], first=first)


def filter_in_order(rows, state=None):
    """rows: (scope+key, order, version, is_delete). Accepted orders and the states left."""
    state, accepted = dict(state or {}), []
    for key, order, version, delete in sorted(rows, key=lambda r: r[1]):
        known = state.get(key)
        if known is not None and version <= known:
            continue
        accepted.append((key, order))
        if delete:
            state.pop(key, None)
        else:
            state[key] = version
    return accepted, state

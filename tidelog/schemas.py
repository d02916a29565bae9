"""Row shapes shared by sources, operators and sinks."""

from __future__ import annotations

# A topic record, as a Kafka source gives it once key and value are cast to text.
TOPIC_RECORD = (
    "topic string, partition int, offset bigint, timestamp timestamp, key string, value string"
)

# The eight business columns of a target table, and the two routing fields dropped before writing.
TARGET_COLUMNS = ("id", "dedup_key", "record", "version", "type", "key", "ngay_cap_nhat", "length")
INTERNAL_COLUMNS = ("iceberg_table", "_cdc_op")
TARGET_SCHEMA = (
    "id string, dedup_key string, record string, version bigint, "
    "type string, key string, ngay_cap_nhat string, length string"
)
LEGACY_TARGET_SCHEMA = (
    "id string, dedup_key string, record string, ingest_time string, "
    "length bigint, key string, type string, version bigint"
)

# Where a row came from; kept beside the business columns in the changelog.
LINEAGE_COLUMNS = ("topic", "partition", "offset", "timestamp")

# A monitoring-station item inside ``data`` of the sample messages: fixed values.
STATION_ITEM = (
    "MaTram string, TenTram string, MoTa string, DiaChiChiTiet string, MaXa string, TenXa string, "
    "MaTinh string, TenTinh string, KinhDo double, ViDo double, LoaiHinhQuanTrac string, "
    "ThongSo string, DonViQuanLyVanHanh string"
)

FILE_ENTRY = "array<struct<path:string,spec_id:int,record_count:bigint>>"
ASSIGNMENT = "array<struct<topic:string,partition:int,offset:bigint,ts:timestamp>>"
COMMIT_EVENT = (
    "event_id string, group_id string, event_ts timestamp, type string, partition int, offset bigint, "
    f"commit_id string, table string, data_files {FILE_ENTRY}, delete_files {FILE_ENTRY}, "
    f"assignments {ASSIGNMENT}"
)

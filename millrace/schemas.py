"""Explicit schemas of the zones."""

from __future__ import annotations

ENVELOPE = (
    "struct<event_id:string,event_type:string,source_system:string,produced_at:string,event_version:string,"
    "correlation_id:string,causation_id:string,tenant_id:string,data_classification:string,retention_policy:string>")

CANONICAL_EVENT = (
    "struct<event_id:string,source_system:string,format:string,metadata:map<string,string>,"
    "patient:struct<id:string,first_name:string,last_name:string>,encounter:struct<id:string,type:string>,"
    "observation:struct<code:string,value:string>,raw_value:string,compliance_applied:boolean,"
    "compliance_flag:boolean,compliance_reason:string,compliance_rule_type:string,compliance_rule_id:string,"
    "compliance_timestamp:string>")

# One stored document per event. canonical_event is also kept as text for drift checks.
RAW_DOCUMENT = (
    f"envelope {ENVELOPE}, canonical_event {CANONICAL_EVENT}, raw string, "
    "lineage array<struct<name:string,timestamp:string>>, trace_id string, span_id string, "
    "transmission_timestamp string, dispatched_at string, _corrupt_record string")

REQUEST = "struct<envelope:string,payload:string>"

RULE = (
    "id string, entity_type string, entity_id string, rule_type string, compliance_flag boolean, "
    "reason_code string, source_format string, event_type string, created_at timestamp, updated_at timestamp")

KEY_VALUE_RULE = "Item struct<" + ",".join(
    [f"{name}:struct<S:string>" for name in
     ("entity_type", "entity_id", "rule_type", "reason_code", "source_format", "event_type")]
    + ["compliance_flag:struct<BOOL:boolean>"]) + ">"

OBJECT_ACCESS = (
    "eventtime timestamp, useridentity struct<principalid:string>, "
    "requestparameters struct<bucketName:string,key:string>, "
    "additionalEventData struct<bytesTransferredIn:bigint>, eventname string, sourceipaddress string")

LOG_LINE = "message string, timestamp bigint"
LOG_RECORD = (
    "struct<level:string,message:string,event:string,event_id:string,trace_id:string,span_id:string,"
    "service:string,source_system:string,format:string,produced_at:string>")

DETECTION_RULES = "rules array<struct<name:string,format:string,prefix:string,contains_key:string>>"

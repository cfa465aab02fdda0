"""Row types of the pipeline."""

from __future__ import annotations

RAW = (
    "record_id long, vendor string, nf_type string, instance_id string, endpoint string, payload binary,"
    " protocol string, timestamp timestamp, meta map<string,string>, schema_version string"
)
#: The same record as JSON on a bus: payload in base64, names as the wire has them.
RAW_JSON = (
    "Source struct<Vendor:string,NFType:string,InstanceID:string,Endpoint:string>, Payload string, Protocol string,"
    " Timestamp timestamp, Meta map<string,string>, SchemaVersion string"
)
SERIES = "array<struct<seq:int,name:string,labels:map<string,string>,value:double,type:string>>"
ATTRIBUTES = (
    "struct<plmn_id:string,nf_instance_id:string,nf_type:string,data_center:string,"
    "slice_id:struct<sst:int,sd:string>,cell_id:struct<global_cell_id:string,nci:bigint,tac:bigint>,vendor:string>"
)
EVENT = (
    "rule_name string, severity string, plmn string, slice_id string, affected_nfs array<string>,"
    " evidence map<string,double>, window_start timestamp, window_end timestamp, timestamp timestamp"
)

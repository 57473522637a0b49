"""Schemas of the envelope and the control tables."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


TEXT, WHOLE, INT, FLAG, TIME = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType()
CLUSTER_TIME = struct(t=WHOLE, i=WHOLE)
CHANGE_EVENT = struct(operation_type=TEXT, document_key=struct(_id=TEXT), full_document=TEXT, ns=struct(db=TEXT, coll=TEXT), cluster_time=CLUSTER_TIME, token=WHOLE)
MESSAGE = struct(
    event_time=TIME, document_id=TEXT, full_document=TEXT, operation_type=TEXT, database=TEXT, collection=TEXT,
    cluster_time=CLUSTER_TIME, is_bootstrap=FLAG, partition_id=INT, token=WHOLE,
)
CHECKPOINT = struct(
    _id=TEXT, partition_id=INT, resume_token=WHOLE, last_cluster_time=CLUSTER_TIME, bootstrap_last_id=TEXT, is_bootstrapping=FLAG,
    updated_at=TIME, bootstrap_start_cluster_time=CLUSTER_TIME,
)
WORKER = struct(_id=TEXT, last_heartbeat=TIME, assigned_partitions=T.ArrayType(INT))
ASSIGNMENT = struct(_id=INT, worker_id=TEXT, assigned_at=TIME, last_heartbeat=TIME)
METADATA = struct(_id=TEXT, total_partition=INT, consumer_group=TEXT)

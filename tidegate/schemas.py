"""Schemas of the inputs, as DDL text or StructType."""

from pyspark.sql import types as T

# A schemaless JSON object: value types, nested values and nulls survive.
PAYLOAD = "map<string,variant>"

ENVELOPE = (
    "database string, `table` string, type string, ts bigint, xid bigint, xoffset bigint, "
    f"data {PAYLOAD}, old {PAYLOAD}, _corrupt_record string"
)

RECORD = (
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
)

OPLOG = f"ts bigint, ns string, op string, o {PAYLOAD}, o2 {PAYLOAD}"

LEDGER = "topic string, group_id string, partition_id int, until_offset bigint"

# Fields of the user entity. The password is read by nobody and not kept.
USER_INT_FIELDS = ("id", "gender", "status", "changePass")
USER_FIELDS = (
    "id",
    "username",
    "realName",
    "avatar",
    "phone",
    "email",
    "birthday",
    "gender",
    "status",
    "createdTime",
    "updatedTime",
    "deletedTime",
    "registerFrom",
    "lastLoginTime",
    "changePass",
    "sign",
    "registerIp",
    "registerUa",
    "registerRs",
    "lastLoginIp",
)
USER_LABEL_FIELDS = ("statusName", "changePassName", "genderName")

USER = T.StructType(
    [
        T.StructField(name, T.IntegerType() if name in USER_INT_FIELDS else T.StringType())
        for name in USER_FIELDS
    ]
)

"""Names, prefixes, labels and defaults that results depend on."""

# Tables that are routed by exact name.
EXACT_TABLES = (
    "sys_user2",
    "t_country",
    "t_province",
    "t_city",
    "t_area",
    "clue_saas_customer_public_sea",
    "saas_customer_public_sea",
    "clue_saas_crm_customer_field",
    "clue_saas_crm_customer_param_field",
    "user",
)

# Collections whose name carries the tenant after the last dot.
TENANT_TABLES = (
    "saas_clue",
    "saas_customer",
    "saas_contact",
    "saas_opport",
    "saas_agreement",
    "saas_record",
)
TENANT_PREFIXES = tuple(name + "." for name in TENANT_TABLES)

# Tables that the applications read.
FIELD_TABLE = "clue_saas_crm_customer_field"
PARAM_TABLE = "clue_saas_crm_customer_param_field"
CLUE_SEA_TABLE = "clue_saas_customer_public_sea"
CUSTOMER_SEA_TABLE = "saas_customer_public_sea"
USER_TABLE = "sys_user2"
CLUE_TABLE = "saas_clue"

# Tables of the earlier router; None admits every operation.
OP_RULES = {
    "order_info": ("insert",),
    "order_detail": ("insert",),
    "base_province": None,
    "user_info": None,
    "sku_info": None,
    "base_trademark": None,
    "base_category3": None,
    "spu_info": None,
}

# Operation codes of the operation log.
OP_NAMES = {"i": "insert", "u": "update", "d": "delete"}

# Topics and consumer groups.
CHANGE_TOPIC = "changes"
TOPIC_PREFIX = "ods_"
GROUP_SUFFIX = "_group3"
OPLOG_DATABASE = "crm"

# Code labels of the user entity, as they appear in stored rows.
STATUS_LABELS = {1: "冻结", 0: "非冻结"}
GENDER_LABELS = {0: "神秘人", 1: "男", 2: "女"}
CHANGE_PASS_LABELS = {0: "未改过密码", 1: "改过密码"}

# Payload keys that are read or written.
TENANT_KEY = "tenantId"
SEA_KEY = "publicSeaId"
SEA_NAME_KEY = "publicSeasName"
USER_ROLE_KEYS = ("creatorId", "lastCharger", "belongToId")
NAME_SUFFIX = "Name"

# Sizes of one read and of one index write.
OPLOG_READ_ROWS = 2000
INDEX_CHUNK_DOCS = 1000
BATCH_SECONDS = 5


def ods_topic(table: str) -> str:
    return TOPIC_PREFIX + table


def group_of(topic: str) -> str:
    return topic + GROUP_SUFFIX

"""Names and flag values shared by feeds and targets."""

# Audit columns every target carries, in target order.
INSERTED_BY = "INSERTED_BY_USER_NAME"
INSERTED_AT = "INSERTED_UTC_DATETIME"
UPDATED_BY = "UPDATED_BY_USER_NAME"
UPDATED_AT = "UPDATED_UTC_DATETIME"
BATCH_SID = "ETL_BATCH_SID"
BATCH_EPOCH = "BATCH_LOAD_EPOCH"
AUDIT = (INSERTED_BY, INSERTED_AT, UPDATED_BY, UPDATED_AT, BATCH_SID)

# Validity of a Type 2 version.
EFFECTIVE = "EFFECTIVE_DATETIME"
EXPIRATION = "EXPIRATION_DATETIME"
CURRENT = "CURRENT_IND"
YES = "Y"
NO = "N"

# Change feed tags.
ACTION = "action_flag"
INSERT = "I"
UPDATE = "U"
ETL_USER = "ETL"

# Columns of a hash-versioned dimension and the tags of its feed.
ROW_HASH = "row_hash"
EFFECTIVE_DATE = "effective_date"
END_DATE = "end_date"
IS_CURRENT = "is_current"
VERSION = "version"
MERGE_ACTION = "merge_action"
MERGE_EXPIRE = "EXPIRE"
MERGE_INSERT = "INSERT"

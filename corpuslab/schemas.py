"""Table shapes shared by sources, operators and sinks (DDL strings)."""

COMMENTS = "file STRING, pos BIGINT, id STRING, text STRING"
VECTORS = "file STRING, pos BIGINT, id STRING, embedding ARRAY<FLOAT>, original_pos BIGINT"
DEAD_LETTER = "file STRING, reason STRING"

THREAD_PAGES = (
    "video_id STRING, page INT, items ARRAY<STRUCT<snippet: STRUCT<"
    "topLevelComment: STRUCT<id: STRING, snippet: STRUCT<textDisplay: STRING>>,"
    "totalReplyCount: BIGINT>>>"
)
REPLIES = "parent_id STRING, seq BIGINT, text STRING"

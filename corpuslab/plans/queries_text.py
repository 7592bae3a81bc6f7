"""Registered queries over comments, files, threads and event keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslab.functions import rules
from corpuslab.functions import text as tx
from corpuslab.operators import cooldown as cd
from corpuslab.operators import cluster as cl
from corpuslab.operators import encode, enrich, fuzzy, joins
from corpuslab.operators.ordering import global_index, hash_sample, id_block
from corpuslab.plans import standins as st
from corpuslab.plans.standins import table
from corpuslab.session import scratch_path
from corpuslab.sources import comments as src
from corpuslab.sources import sinks

QUERIES: dict[str, tuple] = {}


def register(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = (function, sql)
        return function

    return keep


def json_item(value):
    """One JSON array element made from a column."""
    listed = F.to_json(F.array(value))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


@register("comments_scan", f"""
WITH {st.COMMENTS_SQL}
SELECT file, pos, CASE WHEN pos % 3 = 1 THEN 'c' || doc_id ELSE CAST(pos AS VARCHAR) END AS id, text FROM comments""")
def comments_scan(spark, sf):
    rows = st.comments(spark, sf)
    item = (
        F.when(F.col("pos") % 3 == 0, json_item(F.col("text")))
        .when(F.col("pos") % 3 == 1, F.to_json(F.struct(F.concat(F.lit("c"), "doc_id").alias("id"), F.col("text").alias("comment"))))
        .otherwise(F.to_json(F.struct(F.col("text").alias("comment"))))
    )
    chunk = F.floor(F.col("pos") / F.lit(src.CHUNK_ROWS)).cast("bigint").alias("chunk")
    listed = F.array_sort(F.collect_list(F.struct("pos", item.alias("item"))))
    body = F.concat(F.lit("["), F.array_join(F.transform(listed, lambda e: e["item"]), ","), F.lit("]"))
    path = scratch_path(spark, "scan")
    rows.groupBy("file", chunk).agg(body.alias("value")).write.partitionBy("file", "chunk").text(path)
    return src.read_comments(spark, path, "*.txt")


@register("comments_split", f"""
WITH {st.COMMENTS_SQL}
SELECT file, pos, CASE WHEN pos % 2 = 1 THEN 'c' || doc_id ELSE CAST(pos AS VARCHAR) END AS id, text FROM comments""")
def comments_split(spark, sf):
    """The same comments through the block reader of large arrays."""
    item = F.when(F.col("pos") % 2 == 0, json_item(F.col("text"))).otherwise(
        F.to_json(F.struct(F.concat(F.lit("c"), "doc_id").alias("id"), F.col("text").alias("comment"))))
    chunk = F.floor(F.col("pos") / F.lit(src.CHUNK_ROWS)).cast("bigint").alias("chunk")
    listed = F.array_sort(F.collect_list(F.struct("pos", item.alias("item"))))
    body = F.concat(F.lit("["), F.array_join(F.transform(listed, lambda e: e["item"]), ","), F.lit("]"))
    path = scratch_path(spark, "split")
    st.comments(spark, sf).groupBy("file", chunk).agg(body.alias("value")).write.partitionBy("file", "chunk").text(path)
    return src.read_comments(spark, path, "*.txt", split_above=0)


@register("clean_comments", f"""
WITH joined AS (
  SELECT doc_id, text || ' ' || url AS raw FROM documents
  JOIN pages ON doc_id % (SELECT count(*) FROM pages) = page_id)
SELECT doc_id, {st.CLEAN_SQL.format('raw')} AS cleaned FROM joined
WHERE length({st.CLEAN_SQL.format('raw')}) > 0""")
def clean_comments(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    size = table(spark, sf, "pages").agg(F.count(F.lit(1)).alias("n")).scalar()
    docs = st.texts(spark, sf).select("doc_id", "text").withColumn("page_id", F.col("doc_id") % size)
    raw = F.concat_ws(" ", "text", "url")
    return (
        docs.join(pages, "page_id")
        .select("doc_id", tx.clean_comment(raw).alias("cleaned"))
        .filter(F.length("cleaned") > 0)
    )


@register("prepare_text", r"""
WITH s AS (
  SELECT doc_id, regexp_replace(text, '\A[\s\p{Z}\x0B\x1C-\x1F\x85]+|[\s\p{Z}\x0B\x1C-\x1F\x85]+\z', '', 'g') AS t FROM documents)
SELECT doc_id, CASE WHEN length(t) = 0 THEN 'query: empty comment' ELSE 'query: ' || t END AS prepared FROM s""")
def prepare_text(spark, sf):
    return st.texts(spark, sf).select("doc_id", tx.prepare_comment(F.col("text")).alias("prepared"))


@register("txt_to_comments", r"""
WITH wrapped AS (
  SELECT doc_id, CASE WHEN lang = 'en' THEN '{ ' || replace(text, chr(10), ' }' || chr(10) || '{') || '}' ELSE text END AS body
  FROM documents),
lines AS (
  SELECT doc_id, list_filter(list_transform(string_split_regex(body, '\r\n|\n|\r'),
    lambda s: regexp_replace(s, '\A[\x00-\x20]+|[\x00-\x20]+\z', '', 'g')), lambda s: length(s) > 0) AS kept FROM wrapped),
items AS (SELECT doc_id, unnest(range(0, len(kept))) AS pos, unnest(kept) AS line FROM lines)
SELECT doc_id, pos, CASE WHEN regexp_matches(line, '\A\{(.*)\}\z')
  THEN regexp_replace(regexp_extract(line, '\A\{(.*)\}\z', 1), '\A[\x00-\x20]+|[\x00-\x20]+\z', '', 'g') ELSE line END AS text
FROM items""")
def txt_to_comments(spark, sf):
    docs = st.texts(spark, sf)
    braced = F.concat(F.lit("{ "), F.replace("text", F.lit("\n"), F.lit(" }\n{")), F.lit("}"))
    body = docs.select("doc_id", F.when(F.col("lang") == "en", braced).otherwise(F.col("text")).alias("body"))
    return src.line_comments(body, "doc_id", "body")


@register("normalize_names", r"""
SELECT p_partkey, regexp_replace(lower(p_type || ' #' || p_name), '[^a-z0-9]+', '', 'g') AS norm,
  trim(regexp_replace(lower(p_type || ' #' || p_name), '[^a-z0-9\s]', '', 'g')) AS norm_spaced,
  p_name AS stem, p_name || '_deduplicated.npz' AS dedup_name, p_name || '.json' AS json_name,
  p_name AS video, p_name || ' ' || p_brand AS search_key
FROM part""")
def normalize_names(spark, sf):
    name, label = F.col("p_name"), F.concat_ws(" #", "p_type", "p_name")
    return table(spark, sf, "part").select(
        "p_partkey",
        tx.squash_name(label).alias("norm"),
        tx.spaced_name(label).alias("norm_spaced"),
        tx.embedding_base(F.concat(name, F.lit("_embeddings.npz"))).alias("stem"),
        tx.dedup_file_name(F.concat(name, F.lit(".npz"))).alias("dedup_name"),
        tx.txt_to_json_name(F.concat(name, F.lit(".txt"))).alias("json_name"),
        tx.video_of_file(F.concat(name, F.lit("_comments.json"))).alias("video"),
        tx.search_key(name, F.col("p_brand")).alias("search_key"),
    )


@register("thread_flatten", f"WITH {st.THREADS_SQL} SELECT video_id, page, item, seq, text FROM flat")
def thread_flatten(spark, sf):
    return src.join_replies(*st.threads(spark, sf))


@register("comments_array", f"""
WITH {st.THREADS_SQL},
videos AS (SELECT DISTINCT CAST(conv_id // 5 AS VARCHAR) AS video_id FROM conversations
           UNION SELECT 'supplier' || s_suppkey FROM supplier)
SELECT v.video_id, 0 AS chunk,
  CAST(to_json(coalesce(list(text ORDER BY page, item, seq) FILTER (WHERE text IS NOT NULL), [])) AS VARCHAR) AS comments
FROM videos v LEFT JOIN flat ON v.video_id = flat.video_id GROUP BY v.video_id""")
def comments_array(spark, sf):
    placed = sinks.thread_positions(thread_flatten(spark, sf))
    videos = table(spark, sf, "conversations").select(F.floor(F.col("conv_id") / 5).cast("string").alias("video_id"))
    disabled = table(spark, sf, "supplier").select(F.concat(F.lit("supplier"), "s_suppkey").alias("video_id"))
    arrays = sinks.with_empty_videos(
        sinks.comment_arrays(placed, "video_id"), videos.unionByName(disabled), "video_id"
    )
    return arrays.select("video_id", "chunk", F.to_json("comments").alias("comments"))


@register("thread_counts", f"""
WITH {st.THREADS_SQL}
SELECT video_id, page, count(*) FILTER (WHERE seq = 0) AS top_level, count(*) FILTER (WHERE seq > 0) AS replies,
  count(*) AS comments FROM flat GROUP BY video_id, page""")
def thread_counts(spark, sf):
    return thread_flatten(spark, sf).groupBy("video_id", "page").agg(
        F.count_if(F.col("seq") == 0).alias("top_level"),
        F.count_if(F.col("seq") > 0).alias("replies"),
        F.count(F.lit(1)).alias("comments"),
    )


@register("video_stats", """
WITH counts AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)
SELECT c_custkey AS video_id, coalesce(n, 0) AS comment_count, n IS NULL AS disabled
FROM customer LEFT JOIN counts ON c_custkey = conv_id""")
def video_stats(spark, sf):
    counts = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("comment_count")
    )
    videos = table(spark, sf, "customer").select("c_custkey").join(counts, "c_custkey", "left")
    return src.video_stats(videos.withColumnRenamed("c_custkey", "video_id"))


WANTED_SQL = """wanted AS (
  SELECT 'src' || (o_custkey % 40) AS video_id FROM orders UNION ALL SELECT source FROM documents)"""


def _wanted(spark, sf):
    listed = table(spark, sf, "orders").select(F.concat(F.lit("src"), F.col("o_custkey") % 40).alias("video_id"))
    return listed.unionByName(table(spark, sf, "documents").select(F.col("source").alias("video_id")))


def _present(spark, sf):
    name = F.concat("source", F.lit("_comments.json"))
    return table(spark, sf, "documents").select(tx.video_of_file(name).alias("video_id"))


@register("missing_comments", f"""
WITH {WANTED_SQL} SELECT video_id, count(*) AS times FROM wanted
WHERE video_id NOT IN (SELECT source FROM documents) GROUP BY video_id""")
def missing_comments(spark, sf):
    return joins.missing_keys(_wanted(spark, sf), _present(spark, sf), "video_id")


@register("missing_report", f"""
WITH {WANTED_SQL} SELECT count(*) AS total,
  count(*) FILTER (WHERE video_id NOT IN (SELECT source FROM documents)) AS missing FROM wanted""")
def missing_report(spark, sf):
    return joins.missing_report(_wanted(spark, sf), _present(spark, sf), "video_id")


@register("new_files", """
SELECT DISTINCT 'src' || (o_custkey % 60) AS file FROM orders
WHERE 'src' || (o_custkey % 60) NOT IN (SELECT source FROM documents)
  AND 'src' || (o_custkey % 60) NOT IN (SELECT 'src' || (label + 30) FROM embeddings)""")
def new_files(spark, sf):
    listed = table(spark, sf, "orders").select(F.concat(F.lit("src"), F.col("o_custkey") % 60).alias("file"))
    processed = table(spark, sf, "documents").select(F.col("source").alias("file"))
    outputs = table(spark, sf, "embeddings").select(F.concat(F.lit("src"), F.col("label") + 30).alias("file"))
    return joins.pending_files(listed, processed, outputs)


ARCHIVES_SQL = """archives AS (
  SELECT p_brand AS folder, replace(p_name, ' ', '_') || '.npz' AS file FROM part
  UNION ALL SELECT p_brand, replace(p_type, ' ', '_') || '_deduplicated.npz' FROM part WHERE p_size > 48)"""


@register("pick_input", f"""
WITH {ARCHIVES_SQL}, ranked AS (
  SELECT folder, file, row_number() OVER (PARTITION BY folder
    ORDER BY CASE WHEN file LIKE '%\\_deduplicated.npz' ESCAPE '\\' THEN 0 ELSE 1 END, file) AS r FROM archives)
SELECT folder, file FROM ranked WHERE r = 1""")
def pick_input(spark, sf):
    part = table(spark, sf, "part")
    underscored = lambda c: F.replace(c, F.lit(" "), F.lit("_"))
    plain = part.select(F.col("p_brand").alias("folder"), F.concat(underscored("p_name"), F.lit(".npz")).alias("file"))
    reduced = part.filter("p_size > 48").select(
        F.col("p_brand").alias("folder"), F.concat(underscored("p_type"), F.lit("_deduplicated.npz")).alias("file")
    )
    return src.pick_input(plain.unionByName(reduced), ["folder"])


@register("pick_combined", r"""
WITH names AS (
  SELECT c_nationkey AS folder, CASE WHEN c_acctbal > 9000 THEN 'all_' || c_custkey || '_comments.json'
    WHEN c_acctbal > 8000 THEN 'combined_' || c_custkey || '_comments_v2.json'
    WHEN c_acctbal > 7000 THEN 'x_all_comments_' || c_custkey || '.json' ELSE c_custkey || '.json' END AS file FROM customer),
ranked AS (
  SELECT folder, file, CASE WHEN regexp_matches(file, '\Aall.*_comments.*\.json\z') THEN 0
    WHEN regexp_matches(file, '\Acombined.*_comments.*\.json\z') THEN 1
    WHEN regexp_matches(file, '\A.*all.*comments.*\.json\z') THEN 2 END AS r FROM names),
best AS (
  SELECT folder, arg_min(file, (r, file)) FILTER (WHERE r IS NOT NULL) AS b, min(file) AS only_file, count(*) AS n
  FROM ranked GROUP BY folder)
SELECT folder, coalesce(b, only_file) AS file FROM best WHERE b IS NOT NULL OR n = 1""")
def pick_combined(spark, sf):
    key = F.col("c_custkey").cast("string")
    name = (
        F.when(F.col("c_acctbal") > 9000, F.concat(F.lit("all_"), key, F.lit("_comments.json")))
        .when(F.col("c_acctbal") > 8000, F.concat(F.lit("combined_"), key, F.lit("_comments_v2.json")))
        .when(F.col("c_acctbal") > 7000, F.concat(F.lit("x_all_comments_"), key, F.lit(".json")))
        .otherwise(F.concat(key, F.lit(".json")))
    )
    files = table(spark, sf, "customer").select(F.col("c_nationkey").alias("folder"), name.alias("file"))
    return src.pick_combined(files, ["folder"])


@register("ttl_lookup", """
WITH latest AS (
  SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts FROM events GROUP BY user_id)
SELECT c_custkey AS user_id, event_type,
  coalesce((SELECT max(ts) FROM events) - ts < INTERVAL 6 HOURS, false) AS hit
FROM customer LEFT JOIN latest ON user_id = c_custkey""")
def ttl_lookup(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "ts")
    now = table(spark, sf, "events").agg(F.max("ts").alias("now")).scalar()
    requests = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    found = joins.ttl_lookup(requests, events, "user_id", "ts", now, "INTERVAL 6 HOURS")
    return found.select("user_id", "event_type", "hit")


ANCHORS_SQL = """errors AS (SELECT user_id, ts FROM events WHERE event_type = 'error'),
anchors AS (
  SELECT user_id, min(ts) AS anchor_ts FROM errors GROUP BY user_id
  UNION ALL
  SELECT user_id, anchor_ts FROM (
    SELECT a.user_id, (SELECT min(e.ts) FROM errors e WHERE e.user_id = a.user_id
                       AND e.ts >= a.anchor_ts + INTERVAL 24 HOURS) AS anchor_ts FROM anchors a)
  WHERE anchor_ts IS NOT NULL)"""


@register("cooldown_windows", f"WITH RECURSIVE {ANCHORS_SQL} SELECT user_id, anchor_ts FROM anchors")
def cooldown_windows(spark, sf):
    return cd.cooldown_anchors(table(spark, sf, "events").filter("event_type = 'error'"), "user_id", "ts")


@register("cooldown_available", f"""
WITH RECURSIVE {ANCHORS_SQL}
SELECT user_id, max(anchor_ts) AS last_anchor,
  (SELECT max(ts) FROM events) - max(anchor_ts) >= INTERVAL 24 HOURS AS available FROM anchors GROUP BY user_id""")
def cooldown_available(spark, sf):
    now = table(spark, sf, "events").agg(F.max("ts").alias("now")).scalar()
    return cd.available_keys(cooldown_windows(spark, sf), "user_id", now)


def _names(spark, sf):
    part = table(spark, sf, "part")
    targets = part.select(F.concat_ws(" ", "p_name", "p_size").alias("target"))
    files = part.select(
        F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int").alias("dir_rank"),
        F.concat_ws("_", "p_type", "p_name", "p_size").alias("stem"),
    )
    return targets, files.withColumn("file", F.concat("stem", F.lit(".json")))


@register("containment_match", r"""
WITH targets AS (SELECT DISTINCT p_name || ' ' || p_size AS target FROM part),
files AS (
  SELECT DISTINCT CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS dir_rank,
    p_type || '_' || p_name || '_' || p_size AS stem FROM part),
hits AS (
  SELECT target, dir_rank, stem || '.json' AS file FROM targets JOIN files
  ON contains(regexp_replace(lower(stem), '[^a-z0-9]+', '', 'g'), regexp_replace(lower(target), '[^a-z0-9]+', '', 'g'))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY dir_rank, file) AS r FROM hits)
SELECT target, dir_rank, file FROM ranked WHERE r = 1""")
def containment_match(spark, sf):
    return fuzzy.containing_name(*_names(spark, sf))


@register("fuzzy_match")
def fuzzy_match(spark, sf):
    part = table(spark, sf, "part")
    targets = part.select(F.concat_ws(" ", "p_name", F.lit("remix")).alias("target"))
    files = part.select(F.lit(0).alias("dir_rank"), F.concat_ws("_", "p_brand", "p_name").alias("stem"))
    found = fuzzy.best_match(targets, files.withColumn("file", F.concat("stem", F.lit(".json"))))
    return found.withColumn("score", st.rounded(F.col("score")))


@register("per_file_sample", """
WITH ranked AS (
  SELECT source, doc_id, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (PARTITION BY source ORDER BY md5('42' || doc_id), doc_id) AS r FROM documents)
SELECT source, doc_id FROM ranked WHERE r <= greatest(1, floor(n * 0.01 + 0.5))""")
def per_file_sample(spark, sf):
    docs = table(spark, sf, "documents").select("source", "doc_id")
    return hash_sample(docs, "doc_id", tx.sample_quota(F.col("n")), ["source"])


@register("sample_array", """
WITH ranked AS (
  SELECT source, doc_id, text, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (PARTITION BY source ORDER BY md5('42' || doc_id), doc_id) AS r FROM documents),
kept AS (SELECT text, row_number() OVER (ORDER BY source, doc_id) - 1 AS idx FROM ranked WHERE r <= greatest(1, floor(n * 0.01 + 0.5)))
SELECT idx // 10000 AS chunk, list(text ORDER BY idx) AS comments FROM kept GROUP BY 1""")
def sample_array(spark, sf):
    docs = table(spark, sf, "documents").select("source", "doc_id", "text")
    drawn = hash_sample(docs, "doc_id", tx.sample_quota(F.col("n")), ["source"])
    return sinks.sample_arrays(drawn, "source", "doc_id")


@register("global_index", """
SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) - 1 AS global_pos FROM documents""")
def global_positions(spark, sf):
    docs = table(spark, sf, "documents").select("source", "doc_id")
    return global_index(docs, "source", id_block("doc_id"), ["doc_id"]).select("doc_id", "global_pos")


@register("comment_positions", f"WITH {st.COMMENTS_SQL} SELECT file, pos, doc_id FROM comments")
def comment_positions(spark, sf):
    return st.comments(spark, sf).select("file", "pos", "doc_id")


def _keys(spark, sf):
    return st.vectors(spark, sf).select("file", "pos", "id", "original_pos")


@register("enrich_by_id", f"""
WITH {st.COMMENTS_SQL}, texts AS (
  SELECT CAST(doc_id % 400 AS VARCHAR) AS id, arg_max(text, (file, pos)) AS text FROM comments GROUP BY 1)
SELECT vec_id, coalesce(text, '') AS text FROM embeddings LEFT JOIN texts ON CAST(vec_id AS VARCHAR) = id""")
def enrich_by_id(spark, sf):
    shared = st.comments(spark, sf).withColumn("id", (F.col("doc_id") % 400).cast("string"))
    found = enrich.enrich_by_id(_keys(spark, sf), shared)
    return found.select(F.col("pos").alias("vec_id"), "text")


OWN_FILE_SQL = f"""{st.COMMENTS_SQL},
v AS (SELECT 'src' || (vec_id % 20) AS file, vec_id AS pos, CAST(vec_id AS VARCHAR) AS id, label, embedding FROM embeddings),
texts AS (SELECT v.file, v.pos, v.id, v.label, v.embedding, coalesce(a.text, b.text, '') AS text
  FROM v LEFT JOIN comments a ON a.file = v.file AND a.id = v.id LEFT JOIN comments b ON b.file = v.file AND b.pos = v.pos)"""


@register("enrich_per_file", f"WITH {OWN_FILE_SQL} SELECT file, pos, id, text FROM texts")
def enrich_per_file(spark, sf):
    """Text by id in the vector's own file, else by position there."""
    keys = st.vectors(spark, sf).select("file", "pos", "id")
    return enrich.enrich_per_file(keys, st.comments(spark, sf))


@register("results_with_text", f"""
WITH {OWN_FILE_SQL}, sizes AS (SELECT label, count(*) AS cluster_size FROM v GROUP BY label)
SELECT file, pos, id AS comment_id, label AS cluster_label, {st.rounded_sql(st.norm_sql('embedding'))} AS embedding_norm, cluster_size, text
FROM texts JOIN sizes USING (label)""")
def results_with_text(spark, sf):
    """The result rows of a clustering with the text of the row's own file."""
    labelled = st.vectors(spark, sf)
    results = cl.cluster_results(labelled)
    texts = enrich.enrich_per_file(labelled.select("file", "pos", "id"), st.comments(spark, sf)).withColumnRenamed("id", "comment_id")
    rows = texts.join(results, "comment_id")
    return rows.withColumn("embedding_norm", st.rounded(F.col("embedding_norm")))


@register("enrich_by_position", f"""
WITH {st.COMMENTS_SQL}
SELECT vec_id, coalesce(text, '') AS text FROM embeddings
LEFT JOIN comments ON file = 'src' || (vec_id % 20) AND pos = vec_id""")
def enrich_by_position(spark, sf):
    found = enrich.enrich_by_position(_keys(spark, sf), st.comments(spark, sf))
    return found.select(F.col("original_pos").alias("vec_id"), "text")


@register("enrich_priority", f"""
WITH {st.COMMENTS_SQL}, indexed AS (SELECT row_number() OVER (ORDER BY file, pos) - 1 AS g, text FROM comments),
wide AS (SELECT vec_id, vec_id * 3 AS original_pos FROM embeddings)
SELECT vec_id, coalesce(i.text, c.text) AS text FROM wide
LEFT JOIN indexed i ON g = original_pos LEFT JOIN comments c ON c.id = CAST(vec_id AS VARCHAR)""")
def enrich_priority(spark, sf):
    keys = _keys(spark, sf).withColumn("original_pos", F.col("pos") * 3)
    found = enrich.enrich_priority(keys, st.comments(spark, sf), ["pos"])
    return found.select(F.col("pos").alias("vec_id"), "text")


@register("k_bounds", """
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source)
SELECT source, n, greatest(2, least(2, n - 1)) AS k_min,
  greatest(greatest(2, least(2, n - 1)), least(30, n - 1, CAST(floor(sqrt(n)) AS BIGINT) + 5)) AS k_max_elbow,
  greatest(greatest(2, least(2, n - 1)), least(20, n - 1)) AS k_max_silhouette
FROM sizes""")
def k_bounds(spark, sf):
    sizes = table(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    low, elbow = rules.scan_bounds_columns(F.col("n"), rules.K_MIN, rules.K_MAX_ELBOW)
    _, plain = rules.scan_bounds_columns(F.col("n"), rules.K_MIN, rules.K_MAX, adaptive=False)
    return sizes.select("source", "n", low.alias("k_min"), elbow.alias("k_max_elbow"), plain.alias("k_max_silhouette"))


TOKENS_SQL = r"""words AS (
  SELECT doc_id, unnest(regexp_extract_all(lower('query: ' || regexp_replace(text, '\A[\s\p{Z}]+|[\s\p{Z}]+\z', '', 'g')), '[a-z0-9]+')) AS w
  FROM documents),
counts AS (
  SELECT doc_id, CAST(CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 64 AS INTEGER) AS bucket, count(*)::DOUBLE AS n FROM words GROUP BY 1, 2),
lengths AS (SELECT doc_id, sqrt(sum(n * n)) AS len FROM counts GROUP BY doc_id)"""


@register("hash_embed", f"""
WITH {TOKENS_SQL}
SELECT doc_id, bucket, {st.rounded_sql('n / len')} AS weight FROM counts JOIN lengths USING (doc_id)""")
def hash_embed(spark, sf):
    found = encode.hash_embed(st.texts(spark, sf), "doc_id", "text")
    return found.withColumn("weight", st.rounded(F.col("weight")))


@register("embed_documents", f"""
WITH {TOKENS_SQL}
SELECT doc_id, bucket, round(CAST(CAST(n / len AS FLOAT) AS DOUBLE), 6) + 0.0 AS weight FROM counts JOIN lengths USING (doc_id)""")
def embed_documents(spark, sf):
    docs = st.texts(spark, sf).select("doc_id", "text")
    found = encode.embed(docs, "text", encode.hashed_token_encoder(64)).select("doc_id", F.posexplode("embedding"))
    weight = st.rounded(F.col("col").cast("double"))
    return found.filter("col != 0").select("doc_id", F.col("pos").alias("bucket"), weight.alias("weight"))

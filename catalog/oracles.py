"""The same results in DuckDB SQL."""

DOCS = """docs AS (
  SELECT 'corpus/' || lang || '/' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS key,
         CAST(strlen(text) AS BIGINT) AS size, text AS body, lang, source, doc_id
  FROM documents)"""

ORDERS = """objects AS (
  SELECT 'orders/' || CAST(o_orderkey AS VARCHAR) AS key, CAST(floor(o_totalprice * 1000) AS BIGINT) AS size
  FROM orders)"""


def parts_cte(objects: str, chunk: int, name: str = "parts") -> str:
    return f"""{name} AS (
  SELECT key, size, CAST(p AS INTEGER) AS part_number, (p - 1) * {chunk} AS input_offset,
         least({chunk}, size - (p - 1) * {chunk}) AS part_size, CAST(n AS INTEGER) AS n_parts
  FROM (SELECT key, size, n, unnest(generate_series(1, n)) AS p
        FROM (SELECT key, size, greatest(1, (size + {chunk} - 1) // {chunk}) AS n FROM {objects})))"""


def plan_cte(objects: str, chunk: int, n_nodes: int = 1) -> str:
    return parts_cte(objects, chunk) + f""",
numbered AS (
  SELECT *, row_number() OVER (ORDER BY key, part_number) - 1 AS chunk_idx, count(*) OVER () AS n_chunks FROM parts),
plan AS (
  SELECT *, CAST(chunk_idx * {n_nodes} // n_chunks + 1 AS INTEGER) AS node FROM numbered)"""


def bytes_text(n: str, suffix: str = "") -> str:
    return f"""CASE WHEN {n} > 1000000000 THEN printf('%.2f', {n} / 1e9) || 'GB{suffix}'
       WHEN {n} > 1000000 THEN printf('%.2f', {n} / 1e6) || 'MB{suffix}'
       WHEN {n} > 1000 THEN printf('%.2f', {n} / 1e3) || 'KB{suffix}'
       ELSE CAST({n} AS VARCHAR) || 'B{suffix}' END"""


SLICES = f"""{DOCS}, {parts_cte('docs', 1024)},
slices AS (
  SELECT parts.*, substring(hex(body), CAST(2 * input_offset + 1 AS BIGINT), CAST(2 * part_size AS BIGINT)) AS slice
  FROM parts JOIN docs USING (key))"""



def tree_level(level: int) -> str:
    """Three neighbours of the level below become one, unless they are the last."""
    return f"""t{level} AS (
  SELECT key, number // 3 AS number,
         CASE WHEN max(n) = 1 THEN max(digest) ELSE md5(string_agg(digest, '' ORDER BY number)) END AS digest
  FROM (SELECT *, count(*) OVER (PARTITION BY key) AS n FROM t{level - 1}) GROUP BY key, number // 3)"""


RANGES = f"""WITH {SLICES}
SELECT key, part_number, input_offset, part_size AS bytes_read,
       CASE WHEN part_size > 0 THEN 'bytes=' || CAST(input_offset AS VARCHAR) || '-'
            || CAST(input_offset + part_size - 1 AS VARCHAR) END AS range_header,
       md5(slice) AS hex_md5
FROM slices"""

EXECUTED = """executed AS (
  SELECT event_id AS chunk_id, ts, event_type, CAST(floor(value * 1000) AS BIGINT) AS bytes
  FROM events WHERE event_type <> 'error')"""

TICKS = f"""WITH {EXECUTED}, ticks AS (
  SELECT date_trunc('day', ts) AS day, CAST(sum(bytes) AS BIGINT) AS n_bytes, count(*) AS n_chunks
  FROM executed GROUP BY 1),
summed AS (
  SELECT *, CAST(sum(n_bytes) OVER (ORDER BY day) AS BIGINT) AS cum_bytes,
         CAST(sum(n_chunks) OVER (ORDER BY day) AS BIGINT) AS cum_chunks,
         CAST(sum(n_bytes) OVER () AS BIGINT) AS all_bytes, CAST(sum(n_chunks) OVER () AS BIGINT) AS all_chunks
  FROM ticks)
SELECT strftime(day, '%Y-%m-%d %H:%M:%S') AS tick_start, n_bytes, n_chunks, cum_bytes, cum_chunks,
       CAST(all_bytes AS VARCHAR) || ' ' || CAST(cum_bytes AS VARCHAR) AS written_text,
       CAST(cum_chunks AS VARCHAR) || ' / ' || CAST(all_chunks AS VARCHAR) AS finished_text
FROM summed"""

ACCOUNTS = """attempts AS (
  SELECT user_id AS chunk_id, ts, CAST(floor(value * 1000) AS BIGINT) AS bytes_read, event_type = 'error' AS failed,
         400000 AS size
  FROM events),
errors AS (
  SELECT *, coalesce(sum(CAST(failed AS INTEGER)) OVER (
           PARTITION BY chunk_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ep
  FROM attempts),
subs AS (
  SELECT *, (row_number() OVER (PARTITION BY chunk_id, ep ORDER BY ts) - 1) // 10 AS sub FROM errors),
trying AS (
  SELECT *, dense_rank() OVER (PARTITION BY chunk_id ORDER BY ep, sub) AS try,
         sum(CASE WHEN failed THEN 0 ELSE bytes_read END) OVER (
           PARTITION BY chunk_id, ep, sub ORDER BY ts ROWS UNBOUNDED PRECEDING) AS cum
  FROM subs),
dones AS (
  SELECT *, min(CASE WHEN NOT failed AND cum >= size AND try <= 6 THEN ts END) OVER (PARTITION BY chunk_id) AS done_at
  FROM trying),
tries AS (
  SELECT chunk_id, try, count(*) AS n, least(max(cum), max(size)) AS got, bool_or(failed) AS has_failed,
         bool_or(coalesce(ts = done_at, false)) AS done
  FROM dones WHERE try <= 6 AND (done_at IS NULL OR ts <= done_at) GROUP BY chunk_id, try),
ended AS (
  SELECT *, NOT done AND (has_failed OR n = 10) AS lost FROM tries),
accounts AS (
  SELECT chunk_id,
         CASE WHEN bool_or(done) THEN 'done' WHEN bool_or(lost AND try = 6) THEN 'failed' ELSE 'pending' END AS status,
         CAST(max(try) AS INTEGER) AS tries, CAST(sum(n) AS BIGINT) AS responses,
         CAST(sum(got) AS BIGINT) AS bytes_fetched,
         CAST(coalesce(sum(CASE WHEN lost THEN got END), 0) AS BIGINT) AS bytes_wasted,
         CAST(coalesce(sum(CASE WHEN NOT lost THEN got END), 0) AS BIGINT) AS bytes_in_place
  FROM ended GROUP BY chunk_id)"""

READS = """mates AS (
  SELECT doc_id, source, text, unnest(['1', '2']) AS mate FROM documents),
texts AS (
  SELECT 'reads/' || source || '-' || CAST(doc_id // 500 AS VARCHAR) || '.fastq' AS key, doc_id, mate,
         '@r' || CAST(doc_id AS VARCHAR) || '/' || mate AS header,
         translate(md5(text || mate), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq,
         upper(md5(CAST(doc_id AS VARCHAR) || mate)) AS raw_qual
  FROM mates),
quals AS (
  SELECT *, CASE WHEN doc_id % 7 = 0 THEN '@' || substring(raw_qual, 2) ELSE raw_qual END AS qual FROM texts),
recs AS (
  SELECT *, header || chr(10) || seq || chr(10) || '+' || chr(10) || qual || chr(10) AS rec FROM quals),
reads AS (
  SELECT key, row_number() OVER w - 1 AS rec_no,
         CAST(sum(strlen(rec)) OVER w - strlen(rec) AS BIGINT) AS start_offset,
         CAST(strlen(rec) AS BIGINT) AS byte_len, header, seq, '+' AS plus, qual, rec, doc_id,
         'r' || CAST(doc_id AS VARCHAR) AS read_id, mate
  FROM recs WINDOW w AS (PARTITION BY key ORDER BY doc_id, mate)),
lanes AS (
  SELECT key, CAST(sum(byte_len) AS BIGINT) AS size, string_agg(rec, '' ORDER BY doc_id, mate) AS body
  FROM reads GROUP BY key)"""

BOUNDARIES = f"""{READS}, {plan_cte('lanes', 512, 150)},
firsts AS (
  SELECT key, node, min(input_offset) AS first_offset, max(size) AS size FROM plan GROUP BY key, node),
starts AS (
  SELECT key, node, size, first_offset, coalesce(CASE WHEN first_offset > 0 THEN (
           SELECT max(r.start_offset) FROM reads r
           WHERE r.key = firsts.key AND r.start_offset < firsts.first_offset AND r.mate <> '2') END, 0) AS start
  FROM firsts),
bounds AS (
  SELECT key, node, CAST(start AS BIGINT) AS start,
         CAST(coalesce(lead(start) OVER (PARTITION BY key ORDER BY node), size) AS BIGINT) AS "end"
  FROM starts)"""

COPIES = f"""WITH {DOCS}
SELECT 'mirror/' || substring(key, 8) AS key, size, md5(body) AS md5 FROM docs"""

ONCE = f"WITH {DOCS} SELECT key, size, md5(body) AS md5, CAST(1 AS BIGINT) AS n_copies FROM docs"

ORACLES = {
    "objects_docs": f"WITH {DOCS} SELECT key, size, false AS is_marker, md5(body) AS md5 FROM docs",

    "objects_pages": "SELECT url AS key, CAST(strlen(html) AS BIGINT) AS size, false AS is_marker FROM pages",

    "list_objects": f"WITH {DOCS} SELECT key, size, false AS is_marker FROM docs",

    "list_pages": f"WITH {DOCS} SELECT key, size, false AS is_marker FROM docs",

    "head_objects": f"""WITH {DOCS}
SELECT key, size, 'found' AS status FROM docs
UNION ALL SELECT replace(key, '.txt', '.bin'), NULL, 'not_found' FROM docs""",

    "path_list": """SELECT lang || '/' || source || '/' || CAST(doc_id AS VARCHAR) AS source,
       CAST(doc_id AS VARCHAR) AS name FROM documents""",

    "parse_uri": """WITH uris AS (
  SELECT url AS uri FROM pages
  UNION ALL SELECT unnest(['s3://b/k', 's3://b/dir/', 's3://b', 's3://b/', 's3:///k', 's3://b_1/a%20b', 's3://b/a+b'])),
split AS (
  SELECT uri, regexp_extract(uri, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS authority,
         url_decode(regexp_extract(uri, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)) AS path FROM uris),
checked AS (
  SELECT *, CASE WHEN path = '' THEN 'ambiguous' WHEN authority = '' THEN 'no_bucket' END AS uri_error FROM split)
SELECT uri, CASE WHEN uri_error IS NULL THEN authority END AS bucket,
       CASE WHEN uri_error IS NULL THEN substring(path, 2) END AS key, uri_error
FROM checked""",

    "prefix_filter": f"""WITH {DOCS}
SELECT key, size, substring(key, 11) AS relative_path FROM docs WHERE key LIKE 'corpus/en/_%'""",

    "download_targets": f"""WITH {DOCS}
SELECT 'here' AS "case", key, './en/' || substring(key, 11) AS target FROM docs WHERE key LIKE 'corpus/en/_%'
UNION ALL SELECT 'here_top', key, './corpus/' || substring(key, 8) FROM docs
UNION ALL SELECT 'here_all', key, './mybucket/' || key FROM docs
UNION ALL SELECT 'dir', key, 'data/out/' || substring(key, 8) FROM docs""",

    "upload_keys": """WITH paths AS (
  SELECT lang || '/' || CAST(doc_id AS VARCHAR) || '/' || source || '.txt' AS source FROM documents),
keyed AS (
  SELECT source, 'in/' || regexp_extract(source, '[^/]*$') AS target, 'list' AS mode FROM paths
  UNION ALL SELECT source, 'in/' || source, 'recursive' FROM paths)
SELECT source, target, count(*) OVER (PARTITION BY mode, target) AS n_sources, mode FROM keyed""",

    "attach_metadata": f"""WITH {DOCS}, {parts_cte('docs', 1024)}
SELECT key, part_number, 'owner=lab;project=b' AS metadata, 'REDUCED_REDUNDANCY' AS storage_class FROM parts""",

    "bind_targets": f"""WITH {DOCS}, {parts_cte('docs', 1024)}, targets AS (
  SELECT key, 'out/' || substring(key, 11) AS target FROM docs WHERE key LIKE 'corpus/en/_%')
SELECT key, part_number, target, CASE WHEN target IS NULL THEN 'missing_target' END AS target_error
FROM parts LEFT JOIN targets USING (key)""",

    "classify_transfer": f"""WITH {ORDERS}
SELECT key, size, size > 26214400 AS download_multipart, size >= 5242880 AS upload_multipart FROM objects""",

    "plan_parts": f"""WITH {DOCS}, {parts_cte('docs', 1024)}
SELECT key, part_number, input_offset, input_offset AS output_offset, part_size, n_parts FROM parts""",

    "build_plan": f"""WITH {ORDERS}, {plan_cte('objects', 26214400)}
SELECT key, part_number, input_offset, input_offset AS output_offset, part_size, n_parts,
       size > 26214400 AS is_multipart, chunk_idx FROM plan""",

    "grid_assign": f"""WITH {ORDERS}, {plan_cte('objects', 26214400, 7)}
SELECT key, part_number, chunk_idx, node FROM plan""",

    "grid_slice": f"""WITH {ORDERS}, {plan_cte('objects', 26214400)}
SELECT key, part_number, chunk_idx FROM plan
WHERE chunk_idx >= (n_chunks * 2 + 4) // 5 AND chunk_idx < (n_chunks * 3 + 4) // 5""",

    "split_rebase": f"""WITH {ORDERS}, {plan_cte('objects', 26214400, 20000)}
SELECT key, node, part_number, input_offset - min(input_offset) OVER w AS output_offset,
       CAST(sum(part_size) OVER w AS BIGINT) AS node_size, CAST(count(*) OVER w AS INTEGER) AS node_parts
FROM plan WINDOW w AS (PARTITION BY key, node)""",

    "node_summary": f"""WITH {ORDERS}, {plan_cte('objects', 26214400, 5)}, filled AS (
  SELECT CAST(k AS INTEGER) AS node, count(chunk_idx) AS n_chunks,
         CAST(coalesce(sum(part_size), 0) AS BIGINT) AS n_bytes, min(chunk_idx) AS first_idx,
         max(chunk_idx) AS last_idx
  FROM generate_series(1, 5) AS g(k) LEFT JOIN plan ON plan.node = k GROUP BY k),
totals AS (SELECT *, CAST(sum(n_bytes) OVER () AS BIGINT) AS total FROM filled)
SELECT node, n_chunks, n_bytes, first_idx, last_idx, total // 5 AS estimated_bytes,
       n_bytes - total // 5 AS deviation, CASE WHEN total > 0 THEN CAST(n_bytes * 5 AS DOUBLE) / total END AS skew
FROM totals""",

    "transfer_summary": f"""WITH {ORDERS}, summed AS (
  SELECT CAST(sum(size) AS BIGINT) AS total_bytes, count(*) AS n_objects,
         CAST(sum(greatest(1, (size + 26214399) // 26214400)) AS BIGINT) AS n_chunks,
         count(*) FILTER (size <= 26214400) AS n_singles, count(*) FILTER (size > 26214400) AS n_multiparts
  FROM objects)
SELECT *, {bytes_text('total_bytes')} AS total_text FROM summed""",

    "slice_summary": f"""WITH {ORDERS}, {plan_cte('objects', 26214400)}, summed AS (
  SELECT CAST(sum(part_size) AS BIGINT) AS total_bytes, count(DISTINCT key) AS n_objects, count(*) AS n_chunks,
         count(DISTINCT key) FILTER (size <= 26214400) AS n_singles,
         count(DISTINCT key) FILTER (size > 26214400) AS n_multiparts
  FROM plan WHERE chunk_idx >= (n_chunks * 2 + 4) // 5 AND chunk_idx < (n_chunks * 3 + 4) // 5)
SELECT *, {bytes_text('total_bytes')} AS total_text FROM summed""",

    "grid_bind_targets": f"""WITH flags AS (
  SELECT l_returnflag AS key, CAST(sum(l_quantity) AS BIGINT) AS size FROM lineitem GROUP BY 1),
{plan_cte('flags', 4, 3)}
SELECT key, node, 'to/' || key AS target, CAST(NULL AS VARCHAR) AS target_error, count(*) AS n_chunks,
       min(part_number) AS first, max(part_number) AS last
FROM plan GROUP BY key, node""",

    "head_plan": f"""WITH {DOCS}, {parts_cte('docs', 1024)}
SELECT key, part_number, part_size, CAST(NULL AS VARCHAR) AS plan_error FROM parts
UNION ALL SELECT replace(key, '.txt', '.bin'), NULL, NULL, 'missing_size' FROM docs""",

    "plan_transfer_fastq": f"""WITH {BOUNDARIES}, cut AS (
  SELECT key, node, start, "end" - start AS node_size, ("end" - start + 511) // 512 AS n FROM bounds
  WHERE "end" > start)
SELECT key, node, CAST(p AS INTEGER) AS part_number, CAST(n AS INTEGER) AS n_parts,
       start + (p - 1) * 512 AS input_offset, (p - 1) * 512 AS output_offset,
       least(512, node_size - (p - 1) * 512) AS part_size, node_size
FROM (SELECT *, unnest(generate_series(1, n)) AS p FROM cut)""",

    "reassemble_blocks": f"""WITH {SLICES}
SELECT key, input_offset // 4096 AS block, CAST(sum(part_size) AS BIGINT) AS size,
       md5(string_agg(slice, '' ORDER BY part_number)) AS hex_md5
FROM slices GROUP BY 1, 2""",

    "copy_conflicts": f"""WITH {DOCS}, mapped AS (
  SELECT key, size, CASE WHEN doc_id % 2 = 1 THEN 't//' ELSE 't/' END || lang || '/'
         || CAST(doc_id - doc_id % 2 AS VARCHAR) AS target,
         count(*) OVER (PARTITION BY lang, doc_id // 2) > 1 AS shared
  FROM docs)
SELECT key, target, CASE WHEN shared THEN 0 ELSE size END AS bytes,
       CASE WHEN shared THEN 'failed' ELSE 'done' END AS status, CASE WHEN shared THEN 'shared_target' END AS error
FROM mapped""",

    "upload_plan": f"""WITH {ORDERS}, {plan_cte('objects', 26214400)}
SELECT key, part_number, input_offset, part_size, n_parts, size >= 5242880 AS is_multipart, chunk_idx FROM plan""",

    "plan_transfer": f"""WITH {DOCS}, {plan_cte('docs', 1024, 5)}
SELECT key, part_number, input_offset, input_offset - min(input_offset) OVER w AS output_offset, part_size, chunk_idx,
       node, CAST(sum(part_size) OVER w AS BIGINT) AS node_size, './corpus/' || substring(key, 8) AS target
FROM plan WINDOW w AS (PARTITION BY key, node)""",

    "read_ranges": RANGES,
    "slice_bodies": RANGES,

    "complete_manifest": f"""WITH {SLICES}, tagged AS (
  SELECT key, part_number, n_parts, CASE WHEN part_size >= 100 THEN md5(slice) END AS tag FROM slices)
SELECT key, max(n_parts) AS n_parts, count(tag) AS n_tagged,
       CASE WHEN count(tag) = max(n_parts) THEN 'complete' ELSE 'incomplete' END AS status,
       coalesce(string_agg(tag, ',' ORDER BY part_number), '') AS tags
FROM tagged GROUP BY key""",

    "reassemble": f"WITH {DOCS} SELECT key, size, md5(body) AS body_md5 FROM docs",

    "object_digests": f"""WITH {SLICES},
t0 AS (SELECT key, part_number - 1 AS number, md5(unhex(slice)) AS digest FROM slices), {", ".join(map(tree_level, range(1, 10)))}
SELECT key, size, n_parts, 'complete' AS status, digest AS tree_digest
FROM t9 JOIN docs USING (key) JOIN (SELECT key, max(n_parts) AS n_parts FROM slices GROUP BY key) USING (key)""",

    "verify_transfer": f"""WITH {DOCS}, copied AS (
  SELECT key, CAST(length(body) AS BIGINT) AS size FROM docs WHERE lang <> 'de'
  UNION ALL SELECT url, CAST(strlen(html) AS BIGINT) FROM pages)
SELECT key, docs.size AS expected, copied.size AS actual,
       CASE WHEN docs.size IS NULL THEN 'extra' WHEN copied.size IS NULL THEN 'missing'
            WHEN docs.size <> copied.size THEN 'interrupted' ELSE 'ok' END AS status
FROM docs FULL JOIN copied USING (key)""",

    "attempt_accounting": f"WITH {ACCOUNTS} SELECT * FROM accounts",

    "remaining_ranges": f"""WITH {ACCOUNTS}, plan AS (
  SELECT c_custkey AS chunk_id, (c_custkey - 1) * 400000 AS input_offset, CAST(400000 AS BIGINT) AS part_size
  FROM customer)
SELECT chunk_id, input_offset, part_size, coalesce(bytes_in_place, 0) AS bytes_in_place,
       input_offset + coalesce(bytes_in_place, 0) AS remaining_offset,
       part_size - coalesce(bytes_in_place, 0) AS remaining_size
FROM plan LEFT JOIN accounts USING (chunk_id) WHERE coalesce(status, 'pending') <> 'done'""",

    "throughput": f"""WITH {EXECUTED}, grouped AS (
  SELECT event_type, bytes, ts FROM executed UNION ALL SELECT 'all', bytes, ts FROM executed),
summed AS (
  SELECT event_type, CAST(sum(bytes) AS BIGINT) AS n_bytes,
         CAST((epoch_ms(max(ts)) - epoch_ms(min(ts))) // 1000 AS BIGINT) AS seconds FROM grouped GROUP BY event_type),
speeds AS (
  SELECT *, CASE WHEN seconds > 0 THEN n_bytes // seconds END AS bytes_per_second FROM summed)
SELECT event_type, n_bytes, seconds, bytes_per_second,
       CASE WHEN bytes_per_second IS NULL THEN 'unknown' ELSE {bytes_text('bytes_per_second', '/s')} END AS speed_text
FROM speeds""",

    "progress_ticks": TICKS,
    "progress_ticks_stream": TICKS,
    "progress_of_copy": f"""WITH {DOCS}, {parts_cte('docs', 1024)}
SELECT CAST(coalesce(sum(part_size), 0) AS BIGINT) AS n_bytes, count(*) AS n_chunks FROM parts""",

    "incomplete_uploads": """SELECT event_id AS upload_id, user_id AS owner,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS initiated
FROM events i WHERE event_type = 'signup' AND NOT EXISTS (
  SELECT 1 FROM events c WHERE c.event_type = 'purchase' AND c.user_id = i.user_id AND c.ts > i.ts)""",

    "stale_uploads": """SELECT 'up/' || CAST(user_id AS VARCHAR) AS key, event_id AS upload_id,
       strftime(ts, '%d-%m-%Y %H:%M:%S') AS initiated_text
FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY""",

    "read_fastq": f"""WITH {READS}
SELECT key, rec_no, start_offset, byte_len, header, seq, plus, qual, CAST(NULL AS VARCHAR) AS problem, read_id, mate
FROM reads""",

    "fastq_boundaries": f"""WITH {BOUNDARIES} SELECT key, node, start, "end" FROM bounds""",
    "locate_boundaries": f"""WITH {BOUNDARIES} SELECT key, node, start, "end" FROM bounds""",

    "fastq_split": f"""WITH {BOUNDARIES}
SELECT r.key, rec_no, start_offset, read_id, mate, max(b.node) AS node
FROM reads r JOIN bounds b ON r.key = b.key AND b.start <= r.start_offset GROUP BY ALL""",

    "pair_mates": f"""WITH {READS}, pairs AS (
  SELECT key, read_id, max(start_offset) FILTER (mate = '1') AS r1, max(start_offset) FILTER (mate = '2') AS r2
  FROM reads WHERE NOT (mate = '2' AND qual LIKE '@%') GROUP BY key, read_id)
SELECT *, CASE WHEN r1 IS NOT NULL AND r2 IS NOT NULL THEN 'paired' WHEN r1 IS NOT NULL THEN 'orphan_1'
               WHEN r2 IS NOT NULL THEN 'orphan_2' ELSE 'unpaired' END AS status
FROM pairs""",

    "copy_objects": COPIES,
    "copy_multipart": COPIES,
    "copy_parts_store": COPIES,
    "copy_plan": COPIES,
    "grid_copy": COPIES,

    "clean_parts": f"""WITH {DOCS}
SELECT md5('stopped' || chr(10) || 'mirror/' || substring(key, 8)) AS upload_id, 'removed' AS action
FROM docs WHERE size > 1024""",

    "write_split": f"""WITH {DOCS}, {plan_cte('docs', 1024, 5)}, bytes AS (
  SELECT key, node, input_offset, part_size,
         substring(hex(body), CAST(2 * input_offset + 1 AS BIGINT), CAST(2 * part_size AS BIGINT)) AS slice
  FROM plan JOIN docs USING (key))
SELECT 'node=' || CAST(node AS VARCHAR) || '/' || key AS key, CAST(sum(part_size) AS BIGINT) AS size,
       md5(unhex(string_agg(slice, '' ORDER BY input_offset))) AS md5
FROM bytes GROUP BY node, key""",

    "write_fastq_split": f"""WITH {BOUNDARIES}
SELECT 'node=' || CAST(node AS VARCHAR) || '/' || key AS key, "end" - start AS size,
       md5(substring(body, start + 1, "end" - start)) AS md5
FROM bounds JOIN lanes USING (key) WHERE "end" > start""",

    "incremental_copy": ONCE,
    "copy_new": ONCE,
}

"""The registered queries once more, as SQL over the same tables.

Written independently of the operators, for a different engine (DuckDB); used only to check results.
"""

from .operators.curation import MODELS

NOW = "TIMESTAMP '2002-01-01 00:00:00'"
CATALOG_TIME = "TIMESTAMP '2001-01-01 00:00:00'"

# name: (names it needs, body)
_CTES = {}


def _cte(name, body, *needs):
    _CTES[name] = (needs, body)


def sql(body, *needs):
    """A statement with the common table expressions it needs, in order."""
    ordered = []

    def visit(name):
        for need in _CTES[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for need in needs:
        visit(need)
    if not ordered:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1].strip()})" for n in ordered) + "\n" + body.strip()


# --- views ---------------------------------------------------------------------------------------

_STAT = """{size} AS size, o_orderdate - INTERVAL 12 HOUR AS ctime, o_orderdate AS mtime,
       {key} % 3 AS dev, {key} AS ino"""


def _path(key, subdir):
    return f"""'/src/S' || o_custkey || '/' || strftime(o_orderdate, '%Y%m%d') || '_1200_P1_B' || ({key} % 40)
       || '/' || {subdir} || '/' || {key} || '.'
       || CASE o_orderstatus WHEN 'F' THEN 'fast5' WHEN 'O' THEN 'pod5' ELSE 'fastq.gz' END AS filepath"""


_SIZE = "CAST(floor(o_totalprice * 100) AS BIGINT)"
_cte("inventory", f"""
SELECT {_path('o_orderkey', "'raw'")}, {_STAT.format(size=_SIZE, key='o_orderkey')},
       true AS is_file, false AS is_dir, o_orderpriority = '4-NOT SPECIFIED' AS is_symlink
FROM orders""")

_IDENTITY = """
SELECT *, '/links/' || coalesce(extension, 'unknown_extension') AS symlink_dir,
       batch || ':' || sample || ':' || file AS name,
       '/links/' || coalesce(extension, 'unknown_extension') || '/' || batch || ':' || sample || ':' || file AS symlink
FROM (SELECT *, string_split(filepath, '/')[-1] AS file,
        array_to_string(string_split(string_split(filepath, '/')[-3], '_')[4:], '_') AS batch,
        string_split(filepath, '/')[-4] AS sample,
        regexp_replace(filepath, '/[^/]*$', '') AS directory,
        string_split(string_split(filepath, '/')[-1], '.')[1] AS basename,
        nullif(regexp_extract(filepath, '[.](fast5|fastq|fq|pod5)([.]|$)', 1), '') AS extension,
        ctime AS created, mtime AS modified,
        sha256(size || '|' || dev || '|' || ino || '|' || epoch_us(mtime) || '|') AS fingerprint
      FROM {source})"""
_cte("files", _IDENTITY.format(source="inventory"), "inventory")

_RESIZED = "(o_orderpriority = '1-URGENT' AND o_orderstatus IN ('F', 'O'))"
_MOVED = """(CASE WHEN (o_orderpriority = '2-HIGH' AND o_orderstatus = 'F')
                   OR (o_orderpriority = '1-URGENT' AND o_orderstatus = 'O') THEN 'old' ELSE 'raw' END)"""
_GONE = "(o_orderkey + 1000000000)"
_cte("previous_inventory", f"""
SELECT {_path('o_orderkey', _MOVED)},
       {_STAT.format(size=f"CASE WHEN {_RESIZED} THEN {_SIZE} + 1 ELSE {_SIZE} END", key='o_orderkey')},
       CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN NULL ELSE 'indexed' END AS status,
       {CATALOG_TIME} AS observed_at
FROM orders WHERE o_orderdate < {CATALOG_TIME}
UNION ALL
SELECT {_path(_GONE, "'raw'")}, {_STAT.format(size=_SIZE, key=_GONE)}, 'indexed', {CATALOG_TIME}
FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P'
UNION ALL
SELECT {_path('o_orderkey', "'raw'")}, {_STAT.format(size=_SIZE + ' + 7', key='o_orderkey')},
       CASE WHEN o_orderstatus = 'F' THEN 'deleted' ELSE 'deprecated' END, TIMESTAMP '2000-01-01 00:00:00'
FROM orders WHERE o_orderpriority = '3-MEDIUM' AND o_orderdate < {CATALOG_TIME}""")
_cte("catalog", _IDENTITY.format(source="previous_inventory"), "previous_inventory")
_cte("active", "SELECT * FROM catalog WHERE status IS NULL OR status NOT IN ('deprecated', 'deleted')", "catalog")
_cte("versions", f"""
SELECT symlink, filepath, size, modified, fingerprint, observed_at FROM catalog
UNION ALL SELECT symlink, filepath, size, modified, fingerprint, {NOW} FROM files""", "catalog", "files")
_cte("repeated", """
SELECT '/src/S' || l_suppkey || '/20240101_1200_P1_B' || l_linenumber || '/raw/' || l_orderkey || '.pod5' AS filepath,
       l_orderkey AS ino, CAST(l_linenumber AS BIGINT) AS dev FROM lineitem""")
_cte("file_events", """
SELECT event_id, kind AS event_type, folder || 'raw/U' || user_id || '.pod5' AS src_path, ts,
       CAST(floor(value * 100) AS BIGINT) AS size, 'B' || (user_id % 4) AS batch
FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'created' WHEN 'click' THEN 'moved'
                  WHEN 'error' THEN 'deleted' ELSE 'modified' END AS kind,
        '/src/S' || (user_id % 10) || '/20240101_1200_P1_B' || (user_id % 4) || '/' AS folder FROM events)""")
_cte("reports", """
SELECT '/src/reports/N' || s_nationkey || '/' || kind || '_B' || s_suppkey || '_run.txt' AS filepath,
       nullif(kind, 'notes') AS report_type
FROM (SELECT *, CASE WHEN s_acctbal >= 5000 THEN 'final_summary' WHEN s_acctbal >= 2000 THEN 'sequencing_summary'
                ELSE 'notes' END AS kind FROM supplier)""")
_cte("tasks", f"""
SELECT 'T' || o_orderkey AS task_id, 'S' || o_custkey AS sample_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'polish_v0-3-1' WHEN '2-HIGH' THEN 'assemble_v5-0-0'
         ELSE 'survey_v2-2-2' END AS pipeline_id,
       CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'P' THEN 'prepared'
         WHEN o_orderdate >= TIMESTAMP '2001-07-26' THEN 'queued'
         WHEN o_orderdate >= TIMESTAMP '2001-07-20' THEN 'processing' ELSE 'failed' END AS status,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'SJF' ELSE 'LJF' END AS sorting,
       CASE o_orderpriority WHEN '1-URGENT' THEN '04:00' WHEN '2-HIGH' THEN '0-12:30' WHEN '3-MEDIUM' THEN '1-00:00'
         WHEN '5-LOW' THEN '3-00:00' ELSE 'unlimited' END AS timeout,
       CASE o_orderpriority WHEN '1-URGENT' THEN 240 WHEN '2-HIGH' THEN 750 WHEN '3-MEDIUM' THEN 1440
         WHEN '5-LOW' THEN 4320 ELSE 0 END AS minutes,
       {_SIZE} AS input_files_size, o_orderdate AS created, o_orderdate + INTERVAL 90 MINUTE AS queued,
       CASE WHEN o_orderstatus = 'O' THEN o_orderkey + 100000 END AS job_id
FROM orders""")
_cte("jobs", """
SELECT o_orderkey + 100000 AS job_id, 'nxf_T' || o_orderkey AS name, CAST(0 AS BIGINT) AS parent_job_id, 'n1,n2' AS nodes,
       CASE WHEN o_orderdate >= TIMESTAMP '2001-07-20' THEN 'RUNNING' ELSE 'PENDING' END AS status,
       '' AS stderr, '/log/out' AS stdout, CAST(floor(o_totalprice) AS BIGINT) AS priority,
       CASE WHEN o_orderdate >= TIMESTAMP '2001-07-20' THEN epoch_us(o_orderdate) END AS start_us,
       CASE WHEN o_orderdate >= TIMESTAMP '2001-07-20' THEN epoch_us(o_orderdate + INTERVAL 1 DAY) END AS limit_us
FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW'
UNION ALL
SELECT 1000000000 + l_orderkey * 10 + l_linenumber, 'step_' || l_linenumber, l_orderkey + 100000, 'n3',
       CASE WHEN max(l_returnflag) = 'A' THEN 'RUNNING' ELSE 'PENDING' END, '/log/err', '', CAST(l_linenumber AS BIGINT),
       CASE WHEN max(l_returnflag) = 'A' THEN epoch_us(min(l_shipdate)) END, NULL
FROM lineitem GROUP BY l_orderkey, l_linenumber""")
_cte("exit_codes", """
SELECT o_orderkey + 100000 AS job_id, CASE WHEN o_totalprice < 150000 THEN 0 WHEN o_totalprice < 250000 THEN 124
       WHEN o_totalprice < 350000 THEN 1 END AS exit_code
FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW'""")
_cte("samples", """
SELECT 'S' || c_custkey AS sample_id, c_name AS name,
       CASE c_mktsegment WHEN 'FURNITURE' THEN 'deprecated' WHEN 'HOUSEHOLD' THEN NULL ELSE 'indexed' END AS status,
       CAST(floor(c_acctbal * 100) AS BIGINT) AS size, CASE WHEN c_nationkey <> 12 THEN c_mktsegment END AS kit_name,
       'B' || (c_custkey % 40) AS batch_a, 'B' || c_nationkey AS batch_b, c_nationkey % 5 AS region, c_nationkey AS kit_code,
       CASE WHEN c_nationkey > 8 THEN 'r' || c_nationkey END AS pore, c_nationkey < 5 AS basecalled
FROM customer""")
_cte("results", f"""
SELECT 'S' || o_custkey AS sample_id, count(*) AS n_results FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_orderdate < {CATALOG_TIME} GROUP BY 1""")
_cte("listing", """
SELECT 'T' || p_size AS task_id, p_partkey, '/res/T' || p_size || '/out/' || name AS filepath, name,
       CASE WHEN p_brand = 'Brand#1' THEN 0 ELSE CAST(floor(p_retailprice) AS BIGINT) END AS size,
       p_brand <> 'Brand#2' AS is_file, ending
FROM (SELECT *, replace(p_name, ' ', '_') || '_' || p_partkey || ending AS name FROM (SELECT *,
        CASE p_type WHEN 'ECONOMY' THEN '.tsv' WHEN 'SMALL' THEN '_a.csv' WHEN 'LARGE' THEN '_ab.csv'
          WHEN 'MEDIUM' THEN '.svg' ELSE '.log' END AS ending FROM part))""")
_cte("slots", """
SELECT 'tables' AS grp, 'counts' AS type, '*[0-9].tsv' AS mask, '^.*[0-9][.]tsv$' AS pattern
UNION ALL SELECT 'tables', 'sheet', '*_?.csv', '^.*_.[.]csv$' UNION ALL SELECT 'plots', 'page', '[!x]*.svg', '^[^x].*[.]svg$'""")
_cte("expected", """
SELECT task_id, grp, type, mask, pattern FROM (SELECT DISTINCT 'T' || p_size AS task_id FROM part), slots""", "slots")
_cte("found", """
SELECT e.task_id, grp, type, filepath, size FROM expected e JOIN listing l
ON e.task_id = l.task_id AND regexp_matches(l.name, e.pattern)
WHERE is_file AND size > 0""", "expected", "listing")
_cte("totals", """
SELECT e.task_id, e.grp, e.type, e.mask, count(filepath) AS n_files, CAST(coalesce(sum(size), 0) AS BIGINT) AS size
FROM expected e LEFT JOIN found f ON e.task_id = f.task_id AND e.grp = f.grp AND e.type = f.type
GROUP BY 1, 2, 3, 4""", "expected", "found")
_cte("runs", """
SELECT 'B' || n_nationkey AS batch, CASE WHEN r_name <> 'ASIA' THEN 'R' || r_regionkey END AS pore,
       CASE WHEN n_nationkey = 7 THEN NULL WHEN n_nationkey > 10 THEN 'rna' ELSE 'dna' END AS experiment_type
FROM nation JOIN region ON n_regionkey = r_regionkey""")

# --- derived -------------------------------------------------------------------------------------

_KIND = """CASE WHEN o.symlink IS NULL THEN 'added' WHEN n.symlink IS NULL THEN 'deleted'
  WHEN o.filepath <> n.filepath AND o.fingerprint <> n.fingerprint THEN 'moved_modified'
  WHEN o.fingerprint <> n.fingerprint THEN 'modified' WHEN o.filepath <> n.filepath THEN 'moved'
  ELSE 'unchanged' END"""
_cte("diff", f"""
SELECT coalesce(n.symlink, o.symlink) AS symlink, {_KIND} AS change_type,
       o.filepath AS old_filepath, n.filepath AS new_filepath, o.size AS old_size, n.size AS new_size,
       o.modified AS old_modified, n.modified AS new_modified, o.dev AS old_dev, n.dev AS new_dev,
       o.ino AS old_ino, n.ino AS new_ino,
       o.fingerprint AS old_fingerprint, n.fingerprint AS new_fingerprint,
       coalesce(n.batch, o.batch) AS batch, coalesce(n.sample, o.sample) AS sample
FROM files n FULL OUTER JOIN active o ON n.symlink = o.symlink""", "files", "active")


def _word(index):
    return f"sum(CAST('0x' || substr(fingerprint, {index * 6 + 1}, 6) AS BIGINT))"


_SET_PRINT = "sha256(count(*) || " + " || ".join(f"'|' || {_word(i)}" for i in range(6)) + ")"


def _batches(source):
    return f"""
SELECT batch, count(DISTINCT sample) AS n_samples, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS size,
       epoch_us(min(created)) AS created, epoch_us(max(modified)) AS modified, {_SET_PRINT} AS fingerprint
FROM {source} GROUP BY batch"""


def _samples(source):
    return f"""
SELECT f.sample, count(DISTINCT f.batch) AS n_batches, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS size,
       min(lo) AS created, max(hi) AS modified, {_SET_PRINT} AS fingerprint
FROM {source} f JOIN (SELECT batch, epoch_us(min(created)) AS lo, epoch_us(max(modified)) AS hi FROM {source}
                 GROUP BY batch) r ON f.batch = r.batch GROUP BY f.sample"""


_cte("new_batches", _batches("files"), "files")
_cte("old_batches", _batches("active"), "active")
_cte("new_samples", _samples("files"), "files")
_cte("old_samples", _samples("active"), "active")
_cte("changes", """
SELECT sample, batch, symlink, unnest(['size', 'dev', 'ino', 'modified', 'fingerprint']) AS property,
       unnest([CAST(old_size AS VARCHAR), CAST(old_dev AS VARCHAR), CAST(old_ino AS VARCHAR),
               strftime(old_modified, '%Y-%m-%d %H:%M:%S'), old_fingerprint]) AS old,
       unnest([CAST(new_size AS VARCHAR), CAST(new_dev AS VARCHAR), CAST(new_ino AS VARCHAR),
               strftime(new_modified, '%Y-%m-%d %H:%M:%S'), new_fingerprint]) AS new
FROM diff WHERE change_type NOT IN ('added', 'deleted')""", "diff")
_RULE_HITS = """
SELECT sample_id, 'polish_v0-3-1' AS pipeline_id FROM samples WHERE status = 'indexed' AND NOT basecalled
  AND kit_code < 20 AND name IS NOT NULL
UNION ALL
SELECT sample_id, 'assemble_v5-0-0' FROM samples WHERE status = 'indexed' AND size > 250000
  AND kit_name <> 'AUTOMOBILE' AND (batch_a IN ('B3', 'B9') OR batch_b IN ('B3', 'B9'))
UNION ALL
SELECT sample_id, 'survey_v2-2-2' FROM samples WHERE status = 'indexed' AND region IN (1, 3, 4) AND pore IS NULL"""
_cte("candidates", _RULE_HITS, "samples")
_cte("grouped", """
SELECT sample AS task_id, 'signal' AS grp, symlink AS path, f.size FROM files f
WHERE (extension = 'pod5' AND f.size <= 40000000) OR (extension = 'fast5' AND file < '5' AND f.size > 0)
UNION ALL
SELECT sample, 'sequence', f.filepath, f.size FROM files f WHERE f.filepath LIKE '%.fastq.gz' AND f.size >= 2500000""", "files")
_cte("reconciled", f"""
SELECT t.*, running, coalesce(j.status, CASE WHEN e.exit_code IS NULL THEN 'UNKNOWN' WHEN e.exit_code = 0 THEN 'COMPLETED'
           WHEN e.exit_code = 124 THEN 'TIMEOUT' ELSE 'FAILED' END) AS job_state,
       j.job_id IS NOT NULL AS listed, j.start_us, j.limit_us, e.exit_code
FROM (SELECT *, status IN ('queued', 'processing') AND job_id IS NOT NULL AS running FROM tasks) t
LEFT JOIN jobs j ON t.job_id = j.job_id LEFT JOIN exit_codes e ON t.job_id = e.job_id""",
     "tasks", "jobs", "exit_codes")
_NEXT_STATUS = """CASE WHEN NOT running THEN status WHEN listed AND job_state = 'RUNNING' THEN 'processing'
  WHEN listed THEN 'queued' WHEN job_state = 'COMPLETED' THEN 'completed' ELSE 'failed' END"""
_cte("held", """
SELECT b.*, r.pore, r.experiment_type, r.pore IS NULL OR r.experiment_type IS NULL AS held
FROM new_batches b LEFT JOIN runs r ON b.batch = r.batch""", "new_batches", "runs")
_cte("clear_files", "SELECT * FROM files WHERE batch NOT IN (SELECT batch FROM held WHERE held)", "files", "held")


def _hms(seconds):
    return (f"CASE WHEN {seconds} >= 1 THEN printf('%02d:%02d:%02d', CAST(floor({seconds} / 3600) AS BIGINT), "
            f"CAST(floor(({seconds} % 3600) / 60) AS BIGINT), CAST(floor({seconds}) AS BIGINT) % 60) ELSE '00:00:00' END")


def _secs(a, b):
    return f"CAST((epoch_us({b}) - epoch_us({a})) // 1000000 AS BIGINT)"


_GAP = 6 * 3600 * 1_000_000


def _sessions(key, source, gap, extra):
    return f"""
SELECT {key}, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us, count(*) AS n_events{extra}
FROM (SELECT *, sum(opens) OVER (PARTITION BY {key} ORDER BY ts, event_id) AS no FROM (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > {gap} THEN 1 ELSE 0 END AS opens
  FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY ts, event_id))) GROUP BY {key}, no"""


_TASK_RULE = """CASE pipeline_id WHEN 'polish_v0-3-1' THEN '{0}' WHEN 'assemble_v5-0-0' THEN '{1}' ELSE '{2}' END"""
_STEP = _TASK_RULE.format("polish/v031", "assemble/v500", "survey/v222")
_ID = "task_id || '_' || sample_id || '_' || pipeline_id"



def _shaped_inputs(rule):
    return f"""
SELECT task_id, CASE WHEN rule = 'polish_v0-3-1' AND input_files_size > 0 THEN 'prepared'
         WHEN rule = 'assemble_v5-0-0' AND input_files_size > 20000000 THEN 'prepared' ELSE 'disprepared' END AS status,
       CASE rule WHEN 'polish_v0-3-1' THEN
           'polish --in=' || sample_id || ' --threads={{{{ CORES }}}} > {{{{ OUT }}}}/{{{{ RUN_ID }}}}.log'
         WHEN 'assemble_v5-0-0' THEN 'assemble ' || task_id END AS command,
       CASE WHEN rule IS NULL OR rule = 'survey_v2-2-2' THEN 'no shaper' WHEN rule = 'assemble_v5-0-0' AND
         input_files_size <= 20000000 THEN 'no expected outputs' ELSE '' END AS reasons
FROM (SELECT *, {rule} AS rule FROM tasks)"""


ORACLE = {
    "path_identity": sql("""
SELECT filepath, batch, sample, symlink, name, basename, directory, extension, symlink_dir FROM files""", "files"),
    "page_paths": sql("SELECT page_id, regexp_replace(url, '^[a-z]+://[^/]*', '') AS path FROM pages"),
    "file_fingerprint": sql("SELECT filepath, fingerprint FROM files", "files"),
    "sample_identity": sql("""
SELECT sample, sample || '_' || substr(fingerprint, 1, 6) AS sample_id,
       '/proc/' || sample || '/' || substr(fingerprint, 1, 6) AS processing_dir,
       '/res/' || sample || '/' || substr(fingerprint, 1, 6) AS result_dir FROM new_samples""", "new_samples"),
    "task_paths": sql(f"""
SELECT id AS task_id, work AS work_dir, res AS task_result_dir, res || '/logs' AS log_dir,
       res || '/logs/slurm/' || id || '.stdout' AS head_job_stdout,
       res || '/logs/slurm/' || id || '.stderr' AS head_job_stderr, work || '/' || id || '.exitcode' AS head_job_exitcode_f
FROM (SELECT {_ID} AS id, '/proc/' || sample_id || '/' || {_STEP} AS work, '/res/' || sample_id || '/' || {_STEP} AS res
      FROM tasks)""", "tasks"),
    "rules_in_use": sql(f"""
SELECT pipeline_id, {_TASK_RULE.format('v0.3.1', 'v5.0.0', 'v2.2.2')} AS pipeline_version,
       {_TASK_RULE.format('1-02:45', '07:20', 'soon')} AS rule_timeout, count(*) AS n_tasks,
       CAST({_TASK_RULE.format(2, 3, 3)} AS BIGINT) AS n_conditions,
       CAST({_TASK_RULE.format(1605, 440, 0)} AS BIGINT) AS minutes
FROM tasks GROUP BY pipeline_id""", "tasks"),
    "submitted_job_ids": sql("""
SELECT task_id, CASE WHEN status IN ('failed', 'queued') THEN job_id ELSE 0 END AS submitted FROM tasks""", "tasks"),
    "normalised_jobs": sql("""
SELECT job_id, name, CAST(0 AS BIGINT) AS array_job_id, parent_job_id, nodes, 'gpu' AS "partition", priority, status, stderr,
       stdout, CAST(NULL AS INTEGER) AS exit_code, '/work/' || job_id AS work_dir, start_us, limit_us FROM jobs""", "jobs"),
    "command_lines": sql("""
SELECT task_id, 'polish --in=' || sample_id || ' --threads={{ CORES }} > /res/$1/' || sample_id || '/'
       || coalesce(CAST(job_id AS VARCHAR), '') || '.log' AS command FROM tasks""", "tasks"),
    "timeout_minutes": sql("SELECT task_id, timeout, CAST(minutes AS BIGINT) AS minutes FROM tasks", "tasks"),
    "priority_ratio": sql("""
SELECT task_id, CASE WHEN minutes > 0 THEN CAST(input_files_size AS DOUBLE) / minutes END AS ratio FROM tasks""", "tasks"),
    "elapsed_hms": sql(f"""
SELECT task_id, {_hms(_secs('queued', NOW))} AS in_processing, {_hms(_secs('created', 'queued'))} AS waiting,
       '00:00:00' AS backwards, {_hms('(input_files_size / 1e7)')} AS short FROM tasks""", "tasks"),
    "earliest_latest": sql(f"""
SELECT task_id, epoch_us(queued) AS first_us,
       CASE WHEN status = 'failed' THEN epoch_us({NOW}) ELSE epoch_us(created) END AS last_us FROM tasks""", "tasks"),
    "utc_times": sql("""
SELECT event_id, epoch_us(ts) + CASE event_type WHEN 'moved' THEN -10800000000 WHEN 'deleted' THEN 19800000000 ELSE 0 END
       AS utc_us, size * 1000000 AS epoch_us FROM file_events""", "file_events"),
    "exit_status": sql("""
SELECT job_id, CASE WHEN exit_code IS NULL THEN 'UNKNOWN' WHEN exit_code = 0 THEN 'COMPLETED' WHEN exit_code = 124
         THEN 'TIMEOUT' ELSE 'FAILED' END AS job_status,
       CASE WHEN exit_code = 0 THEN 'completed' ELSE 'failed' END AS task_status, 'queued' AS if_listed
FROM exit_codes""", "exit_codes"),
    "map_edits": sql("""
SELECT sample_id, CASE WHEN basecalled THEN 'assemble_v5-0-0,polish_v0-3-1' ELSE 'assemble_v5-0-0' END AS put_keys,
       'failed' AS replaced, CASE WHEN basecalled THEN CAST(0 AS BIGINT) END AS "left" FROM samples""", "samples"),
    "sample_documents": sql("""
SELECT sample_id, size, kit_name, CAST(NULL AS VARCHAR) AS private,
       CASE WHEN batch_a = batch_b THEN batch_a ELSE least(batch_a, batch_b) || ',' || greatest(batch_a, batch_b) END
         AS batches, CASE WHEN basecalled THEN 'polish_v0-3-1' END AS task_rules FROM samples""", "samples"),
    "defaulted_samples": sql("""
SELECT sample_id, name, coalesce(status, 'indexed') AS status, '' AS processing_dir, '' AS previous_version, size,
       CAST(0 AS BIGINT) AS n_files, CAST(basecalled AS BIGINT) AS n_tasks FROM samples""", "samples"),
    "expected_rows": sql('SELECT task_id, grp AS "group", type, mask FROM expected', "expected"),

    "active_files": sql("SELECT symlink, size, status FROM active", "active"),
    "catalog_find": sql("SELECT symlink, size FROM active WHERE size >= 20000000", "active"),
    "tasks_by_status": sql(
        "SELECT task_id, status FROM tasks WHERE status IN ('prepared', 'queued', 'processing')", "tasks"),
    "find_one_file": sql("SELECT symlink, size FROM active WHERE batch = 'B7' ORDER BY symlink LIMIT 1", "active"),
    "tasks_not_exists": sql("SELECT sample_id FROM samples WHERE NOT basecalled", "samples"),
    "rule_filter": sql("""
SELECT sample_id, coalesce(status = 'indexed', false) AS eq, status IS NULL AS eq_null,
       coalesce(status <> 'indexed', true) AS ne, coalesce(kit_name NOT IN ('BUILDING', 'MACHINERY'), true) AS ne_list,
       size > 500000 AS gt, size >= 500000 AS gte, size < 500000 AS lt, size <= 500000 AS lte, region IN (1, 3) AS "in",
       coalesce(kit_name <> 'BUILDING', false) AS nin, pore IS NOT NULL AS "exists", pore IS NULL AS absent,
       batch_a = 'B7' OR batch_b = 'B7' AS array_eq, batch_a <> 'B7' AND batch_b <> 'B7' AS array_ne,
       batch_a > 'B8' OR batch_b > 'B8' AS array_gt FROM samples""", "samples"),
    "rule_matches": sql("""
SELECT sample_id, size FROM samples WHERE size > 250000 AND kit_name <> 'AUTOMOBILE'
  AND (batch_a IN ('B3', 'B9') OR batch_b IN ('B3', 'B9'))""", "samples"),
    "inventory_filter": sql("""
SELECT filepath, filepath AS path, symlink AS link, size FROM files
WHERE size BETWEEN 5000000 AND 40000000 AND extension IN ('fast5', 'fastq') AND NOT is_symlink""", "files"),
    "mask_matches": sql("""
SELECT page_id, name LIKE '%.html' AS html, regexp_matches(name, '^[1-4].') AS digits,
       regexp_matches(name, '^[^1-4]') AS others, regexp_matches(path, '/en/[^/]*[.]html$') AS english,
       name <> '' AS own_mask, CASE WHEN page_id % 2 = 0 THEN regexp_matches(name, '^[1-4].') ELSE regexp_matches(name, '^[^1-4]') END
         AS own_class, true AS dollar
FROM (SELECT *, string_split(path, '/')[-1] AS name FROM (
  SELECT page_id, regexp_extract(url, '^[a-z]+://([^?#]*)', 1) AS path FROM pages))""" .replace(
        "name <> '' AS own_mask", "true AS own_mask")),
    "watched_events": sql("""
SELECT event_id, upper(src_path) AS path FROM file_events WHERE size % 2 = 0""", "file_events"),
    "validated_tasks": sql("""
SELECT task_id, CASE WHEN reasons = '' THEN 'prepared' ELSE 'disprepared' END AS status, reasons
FROM (SELECT task_id, concat_ws(';', CASE WHEN sorting <> 'SJF' THEN 'no command' END,
        CASE WHEN status = 'failed' THEN 'no input groups' END,
        CASE WHEN status = 'completed' OR input_files_size <= 0 THEN 'no input bytes' END,
        CASE WHEN pipeline_id = 'assemble_v5-0-0' THEN 'no expected outputs' END) AS reasons FROM tasks)""", "tasks"),

    "snapshot_diff": sql("""
SELECT symlink, change_type, old_filepath, new_filepath, old_size, new_size, batch, sample,
       epoch_us(old_modified) AS old_us, epoch_us(new_modified) AS new_us FROM diff""", "diff"),
    "snapshot_diff_counts": sql("SELECT change_type, count(*) AS n_files FROM diff GROUP BY 1", "diff"),
    "indexing_counts": sql("""
SELECT count(*) AS files, count(DISTINCT batch) AS batches, count(DISTINCT sample) AS samples
FROM diff WHERE change_type <> 'unchanged'""", "diff"),
    "diff_properties": sql("SELECT * FROM changes WHERE old <> new", "changes"),
    "nested_changes": sql("""
SELECT sample, batch, symlink, string_agg(property, ',' ORDER BY property) AS properties,
       max(CASE WHEN property = 'size' THEN old END) AS old_size, max(CASE WHEN property = 'size' THEN new END) AS new_size
FROM changes WHERE old <> new GROUP BY 1, 2, 3""", "changes"),
    "listing_only": sql("SELECT symlink, new_size AS size FROM diff WHERE change_type = 'added'", "diff"),
    "catalog_only": sql("SELECT symlink, old_size AS size FROM diff WHERE change_type = 'deleted'", "diff"),
    "in_both": sql("SELECT symlink, new_size AS size FROM diff WHERE change_type NOT IN ('added', 'deleted')", "diff"),
    "three_way_keys": sql("""
SELECT symlink, CASE change_type WHEN 'added' THEN 'listing' WHEN 'deleted' THEN 'catalog' ELSE 'both' END AS side
FROM diff""", "diff"),
    "dedupe_paths": sql("SELECT DISTINCT filepath FROM repeated", "repeated"),
    "one_per_link": sql("""
SELECT symlink, min(filepath) AS filepath, arg_min(size, (filepath, size)) AS size
FROM (SELECT symlink, filepath, size FROM active UNION ALL SELECT symlink, filepath, size FROM files) GROUP BY symlink""",
                        "active", "files"),
    "union_roots": sql("""
SELECT filepath, size FROM inventory UNION ALL SELECT filepath, NULL FROM reports""", "inventory", "reports"),
    "unique_violations": sql("SELECT ino, dev, count(*) AS n FROM repeated GROUP BY 1, 2 HAVING count(*) > 1", "repeated"),
    "unique_active": sql("""
SELECT 'all' AS rows, dev, ino, count(*) AS n FROM catalog GROUP BY 2, 3 HAVING count(*) > 1
UNION ALL SELECT 'active', dev, ino, count(*) FROM active GROUP BY 2, 3 HAVING count(*) > 1""", "catalog", "active"),

    "batch_rollup": sql("SELECT * FROM new_batches", "new_batches"),
    "sample_rollup": sql("SELECT * FROM new_samples", "new_samples"),
    "batch_samples": sql("""
SELECT batch, sample, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS size FROM files GROUP BY 1, 2""", "files"),
    "batch_sample_sets": sql("""
SELECT p.batch, CAST('0x' || substr(sha256(sample), 1, 12) AS BIGINT) % pages AS page,
       string_agg(sample, ',' ORDER BY sample) AS members
FROM (SELECT DISTINCT batch, sample FROM files) p
JOIN (SELECT batch, CAST(ceil(count(DISTINCT sample) / 100.0) AS BIGINT) AS pages FROM files GROUP BY 1) c
  ON p.batch = c.batch GROUP BY 1, 2""", "files"),
    "batch_file_maps": sql("""
SELECT p.batch, CAST('0x' || substr(sha256(symlink), 1, 12) AS BIGINT) % pages AS page, count(*) AS n_files,
       sha256(string_agg(symlink || '=' || fingerprint, ',' ORDER BY symlink || '=' || fingerprint)) AS files
FROM files p
JOIN (SELECT batch, CAST(ceil(count(*) / 100.0) AS BIGINT) AS pages FROM files GROUP BY 1) c
  ON p.batch = c.batch GROUP BY 1, 2""", "files"),
    "batch_memberships": sql("""
SELECT batch, count(DISTINCT sample_id) AS n_samples FROM (
  SELECT batch_a AS batch, sample_id FROM samples UNION ALL SELECT batch_b, sample_id FROM samples) GROUP BY 1""", "samples"),
    "rollup_delta": sql("SELECT * FROM new_batches", "new_batches"),
    "sample_rollup_delta": sql("SELECT * FROM new_samples", "new_samples"),
    "affected_batches": sql("SELECT DISTINCT batch FROM diff WHERE change_type NOT IN ('unchanged', 'moved')", "diff"),
    "affected_samples": sql("""
SELECT sample, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS size FROM files WHERE sample IN (
  SELECT sample FROM diff WHERE change_type NOT IN ('unchanged', 'moved')) GROUP BY 1""", "files", "diff"),
    "empty_entities": sql("""
SELECT sample_id, CASE WHEN sample_id IN (SELECT sample FROM files) THEN status ELSE 'deprecated' END AS status
FROM samples""", "samples", "files"),
    "hierarchy_totals": sql("""
SELECT coalesce(sample, '*') AS sample, coalesce(batch, '*') AS batch, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS size
FROM files GROUP BY ROLLUP (files.sample, files.batch)""", "files"),
    "directory_rollup": sql("""
SELECT directory, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS size, regexp_replace(directory, '/[^/]*$', '') AS parent,
       CAST(0 AS BIGINT) AS n_children FROM files GROUP BY directory""", "files"),
    "child_directories": sql("""
SELECT DISTINCT regexp_replace(directory, '/[^/]*$', '') AS directory, directory AS child FROM files""", "files"),
    "member_differences": sql("""
SELECT batch, symlink, CASE change_type WHEN 'added' THEN 'added' ELSE 'removed' END AS difference
FROM diff WHERE change_type IN ('added', 'deleted')""", "diff"),

    "version_chain": sql("""
SELECT symlink, epoch_us(observed_at) AS observed_us, fingerprint, lag(fingerprint) OVER w AS previous_version,
       lead(fingerprint) OVER w AS next_version
FROM versions WINDOW w AS (PARTITION BY symlink ORDER BY observed_at, fingerprint)""", "versions"),
    "live_version": sql("""
SELECT symlink, arg_max(size, observed_at) AS size, arg_max(fingerprint, observed_at) AS fingerprint
FROM versions GROUP BY 1""", "versions"),
    "version_changes": sql("""
SELECT * FROM (
  SELECT symlink, epoch_us(observed_at) AS observed_at, 'size' AS property,
         CAST(lag(size) OVER w AS VARCHAR) AS old, CAST(size AS VARCHAR) AS new
  FROM versions WINDOW w AS (PARTITION BY symlink ORDER BY observed_at)
  UNION ALL
  SELECT symlink, epoch_us(observed_at), 'filepath', lag(filepath) OVER w, filepath
  FROM versions WINDOW w AS (PARTITION BY symlink ORDER BY observed_at)) WHERE old <> new""", "versions"),
    "property_differences": sql("""
SELECT symlink, 'size' AS property, CAST(old_size AS VARCHAR) AS old, CAST(new_size AS VARCHAR) AS new FROM diff
WHERE old_size <> new_size
UNION ALL SELECT symlink, 'filepath', old_filepath, new_filepath FROM diff WHERE old_filepath <> new_filepath
UNION ALL SELECT symlink, 'dev', CAST(old_dev AS VARCHAR), CAST(new_dev AS VARCHAR) FROM diff WHERE old_dev <> new_dev""",
                                "diff"),
    "superseded": sql(f"""
SELECT a.symlink, CASE WHEN hit THEN 'deprecated' ELSE status END AS status,
       CASE WHEN hit THEN epoch_us({NOW}) END AS updated_us
FROM (SELECT *, fingerprint IN (SELECT old_fingerprint FROM diff WHERE change_type IN ('modified', 'moved_modified')) AS hit
      FROM active) a""", "active", "diff"),
    "upsert_files": sql(f"""
SELECT coalesce(n.symlink, o.symlink) AS symlink, coalesce(n.filepath, o.filepath) AS filepath,
       coalesce(n.size, o.size) AS size, o.status,
       CASE WHEN o.symlink IS NULL THEN epoch_us({NOW}) END AS created_us,
       CASE WHEN n.symlink IS NOT NULL THEN epoch_us({NOW}) END AS updated_us
FROM files n FULL OUTER JOIN active o ON n.symlink = o.symlink""", "files", "active"),
    "update_files": sql(f"""
SELECT o.symlink, coalesce(n.size, o.size) AS size, o.status,
       CASE WHEN n.symlink IS NULL THEN NULL WHEN n.dev = 1 THEN epoch_us({CATALOG_TIME}) ELSE epoch_us({NOW}) END
         AS updated_us, CAST(NULL AS BIGINT) AS created_us
FROM active o LEFT JOIN files n ON n.symlink = o.symlink""", "files", "active"),
    "update_mismatches": sql("""
SELECT f.symlink, coalesce(n, 0) AS matched FROM files f
LEFT JOIN (SELECT symlink, count(*) AS n FROM catalog GROUP BY 1) c ON f.symlink = c.symlink
WHERE coalesce(n, 0) <> 1""", "files", "catalog"),
    "update_many": sql(f"""
SELECT symlink, CASE WHEN size > 30000000 THEN 'big' ELSE status END AS status,
       CASE WHEN size > 30000000 THEN epoch_us({NOW}) END AS updated_us FROM active""", "active"),
    "delete_files": sql(
        "SELECT symlink, size FROM active WHERE symlink IN (SELECT symlink FROM files)", "active", "files"),
    "append_files": sql(f"""
SELECT symlink, size, status, CAST(NULL AS BIGINT) AS created_us FROM active
UNION ALL SELECT symlink, new_size, 'indexed', epoch_us({NOW}) FROM diff WHERE change_type = 'added'""", "active", "diff"),
    "soft_delete": sql(f"""
SELECT c.symlink, c.size, CASE WHEN hit THEN 'deleted' ELSE status END AS status,
       CASE WHEN hit THEN epoch_us({NOW}) END AS deleted_us
FROM (SELECT *, symlink IN (SELECT symlink FROM diff WHERE change_type = 'deleted')
        AND (status IS NULL OR status = 'indexed') AS hit FROM catalog) c""", "catalog", "diff"),
    "move_files": sql(f"""
SELECT c.symlink, c.size, c.status, CASE WHEN hit THEN new_filepath ELSE filepath END AS filepath,
       regexp_replace(CASE WHEN hit THEN new_filepath ELSE filepath END, '/[^/]*$', '') AS directory,
       CASE WHEN hit THEN epoch_us({NOW}) END AS updated_us
FROM (SELECT k.*, d.new_filepath, d.symlink IS NOT NULL AND (status IS NULL OR status = 'indexed') AS hit
      FROM catalog k LEFT JOIN (SELECT * FROM diff WHERE change_type IN ('moved', 'moved_modified')) d
      ON k.symlink = d.symlink) c""", "catalog", "diff"),
    "batch_versions": sql("""
SELECT n.batch, n.size, n.fingerprint, coalesce(o.fingerprint, '') AS previous_version, 'indexed' AS status
FROM new_batches n LEFT JOIN old_batches o ON n.batch = o.batch
WHERE o.fingerprint IS NULL OR o.fingerprint <> n.fingerprint""", "new_batches", "old_batches"),
    "sample_versions": sql("""
SELECT n.sample, n.size, n.fingerprint, coalesce(o.fingerprint, '') AS previous_version, 'indexed' AS status
FROM new_samples n LEFT JOIN old_samples o ON n.sample = o.sample
WHERE o.fingerprint IS NULL OR o.fingerprint <> n.fingerprint""", "new_samples", "old_samples"),
    "vanished_pairs": sql("""
SELECT batch || ':' || sample AS pair, count(*) AS n_files FROM active
WHERE (batch, sample) NOT IN (SELECT (batch, sample) FROM files) GROUP BY 1""".replace(
        "(batch, sample) NOT IN (SELECT (batch, sample) FROM files)",
        "batch || ':' || sample NOT IN (SELECT batch || ':' || sample FROM files)"), "active", "files"),
    "catalog_roundtrip": sql("""
SELECT symlink, coalesce(new_filepath, old_filepath) AS filepath, coalesce(new_size, old_size) AS size,
       coalesce(new_fingerprint, old_fingerprint) AS fingerprint FROM diff""", "diff"),
    "newest_files": sql("""
SELECT symlink, size, epoch_us(modified) AS modified_us FROM files ORDER BY modified DESC, symlink LIMIT 25""", "files"),

    "report_files": sql("SELECT filepath, report_type FROM reports WHERE report_type IS NOT NULL", "reports"),
    "report_for_batch": sql("""
SELECT b.batch, min(CASE WHEN report_type = 'final_summary' THEN filepath END) AS final_summary,
       min(CASE WHEN report_type = 'sequencing_summary' THEN filepath END) AS sequencing_summary
FROM new_batches b LEFT JOIN reports r ON contains(string_split(r.filepath, '/')[-1], b.batch) GROUP BY 1""",
                            "new_batches", "reports"),

    "candidates": sql("SELECT sample_id, pipeline_id FROM candidates", "candidates"),
    "candidates_without_tasks": sql("""
SELECT sample_id, pipeline_id FROM candidates c WHERE NOT EXISTS (
  SELECT 1 FROM tasks t WHERE t.sample_id = c.sample_id AND t.pipeline_id = c.pipeline_id)""", "candidates", "tasks"),
    "new_tasks": sql(f"""
SELECT sample_id || '_' || pipeline_id AS task_id, {_TASK_RULE.format('SJF', 'LJF', 'SJF')} AS sorting,
       {_TASK_RULE.format('1-02:45', '07:20', 'soon')} AS timeout, 'created' AS status, epoch_us({NOW}) AS created_us
FROM candidates WHERE sample_id IN (SELECT sample_id FROM results)""", "candidates", "results"),
    "rejected_candidates": sql("""
SELECT sample_id, pipeline_id, 'result' AS lacking FROM candidates WHERE sample_id NOT IN (SELECT sample_id FROM results)""",
                               "candidates", "results"),
    "input_groups": sql('SELECT task_id, grp AS "group", path, size FROM grouped', "grouped"),
    "input_totals": sql("""
SELECT task_id, grp AS "group", count(*) AS n_files, CAST(sum(size) AS BIGINT) AS size FROM grouped GROUP BY 1, 2""",
                        "grouped"),
    "input_sizes": sql("""
SELECT task_id, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS size FROM grouped GROUP BY 1""", "grouped"),
    "group_readiness": sql("""
SELECT sample_id AS task_id, CASE WHEN n_reads = 0 THEN 'sequence' ELSE '' END AS missing_required,
       CASE WHEN n_source = 0 THEN 'signal' ELSE '' END AS missing_preferred, n_reads > 0 AS ready
FROM (SELECT sample_id, count(CASE WHEN grp = 'signal' THEN 1 END) AS n_source,
        count(CASE WHEN grp = 'sequence' THEN 1 END) AS n_reads
      FROM samples LEFT JOIN grouped ON sample_id = task_id GROUP BY 1)""", "samples", "grouped"),
    "queue_usage": sql("""
SELECT sorting, count(*) AS in_use FROM tasks WHERE status IN ('queued', 'processing') GROUP BY 1""", "tasks"),
    "free_slots": sql("""
SELECT q.sorting, capacity, count(t.task_id) AS in_use, greatest(capacity - count(t.task_id), 0) AS slots
FROM (SELECT 'SJF' AS sorting, CAST(150 AS BIGINT) AS capacity UNION ALL SELECT 'LJF', 400) q
LEFT JOIN tasks t ON q.sorting = t.sorting AND t.status IN ('queued', 'processing') GROUP BY 1, 2""", "tasks"),
    "weighted_tasks": sql("""
SELECT task_id, sorting, ratio, CASE WHEN sorting = 'LJF' THEN -ratio ELSE ratio END AS position
FROM (SELECT *, CASE WHEN minutes > 0 THEN CAST(input_files_size AS DOUBLE) / minutes END AS ratio FROM tasks)
WHERE status = 'prepared'""", "tasks"),
    "admission": sql("""
SELECT r.task_id, r.sorting, r.ratio, r."rank" FROM (
  SELECT task_id, sorting, ratio, row_number() OVER (PARTITION BY sorting
           ORDER BY CASE WHEN sorting = 'LJF' THEN -ratio ELSE ratio END NULLS LAST, task_id) AS "rank"
  FROM (SELECT *, CASE WHEN minutes > 0 THEN CAST(input_files_size AS DOUBLE) / minutes END AS ratio FROM tasks)
  WHERE status = 'prepared') r
LEFT JOIN (SELECT sorting, count(*) AS in_use FROM tasks WHERE status IN ('queued', 'processing') GROUP BY 1) u
  ON r.sorting = u.sorting
WHERE "rank" <= CASE r.sorting WHEN 'SJF' THEN 150 ELSE 400 END - coalesce(in_use, 0)""", "tasks"),

    "child_jobs": sql("""
SELECT c.job_id, c.parent_job_id, p.name AS parent_name, c.status FROM jobs c JOIN jobs p ON c.parent_job_id = p.job_id""",
                      "jobs"),
    "child_counts": sql("""
SELECT c.parent_job_id, count(*) AS n_children, count(CASE WHEN c.status = 'RUNNING' THEN 1 END) AS n_running
FROM jobs c JOIN jobs p ON c.parent_job_id = p.job_id GROUP BY 1""", "jobs"),
    "child_job_maps": sql("""
SELECT parent_job_id, CAST('0x' || substr(sha256(CAST(job_id AS VARCHAR)), 1, 12) AS BIGINT) % pages AS page, string_agg(CAST(job_id AS VARCHAR), ',' ORDER BY job_id) AS children
FROM (SELECT c.parent_job_id, c.job_id, CAST(ceil(count(*) OVER (PARTITION BY c.parent_job_id) / 2.0) AS BIGINT) AS pages
      FROM jobs c JOIN jobs p ON c.parent_job_id = p.job_id) GROUP BY 1, 2""", "jobs"),
    "task_documents": sql("""
SELECT task_id, s.name AS sample_name, n_results FROM tasks t LEFT JOIN samples s ON t.sample_id = s.sample_id
LEFT JOIN results r ON t.sample_id = r.sample_id WHERE t.status IN ('prepared', 'failed')""", "tasks", "samples", "results"),
    "reconcile_tasks": sql(f"""
SELECT task_id, {_NEXT_STATUS} AS status, CASE WHEN running THEN job_state END AS job_status,
       CASE WHEN running AND listed THEN start_us END AS start_us, CASE WHEN running AND listed THEN limit_us END AS limit_us,
       CASE WHEN running AND NOT listed THEN epoch_us({NOW}) END AS finish_us,
       CASE WHEN running AND NOT listed THEN exit_code END AS exit_code,
       CASE WHEN running THEN {_hms(_secs('queued', NOW))} END AS time_in_processing,
       CASE WHEN running THEN {_hms(_secs('created', NOW))} END AS time_from_creation_to_finish,
       CASE WHEN running THEN epoch_us({NOW}) END AS updated_us
FROM reconciled""", "reconciled"),
    "remaining_queue": sql("SELECT task_id, sorting FROM reconciled WHERE running AND listed", "reconciled"),
    "queued_tasks": sql(f"""
SELECT task_id, CASE WHEN ok THEN 'queued' ELSE 'failed' END AS status,
       CASE WHEN ok THEN CAST(substr(task_id, 2) AS BIGINT) + 500000 ELSE 0 END AS job_id,
       CASE WHEN ok THEN epoch_us({NOW}) ELSE epoch_us(queued) END AS queued_us, CASE WHEN ok THEN '00:00:00' END
         AS time_in_processing
FROM (SELECT *, input_files_size < 40000000 AS ok FROM tasks WHERE status = 'prepared')""", "tasks"),
    "sample_task_states": sql("""
SELECT t.sample_id, pipeline_id, arg_max(t.status, (epoch_us(queued), task_id)) AS status
FROM tasks t JOIN samples s ON t.sample_id = s.sample_id GROUP BY 1, 2
UNION ALL SELECT sample_id, 'polish_v0-3-1', 'completed' FROM samples WHERE basecalled AND sample_id NOT IN (
  SELECT sample_id FROM tasks WHERE pipeline_id = 'polish_v0-3-1')""", "tasks", "samples"),
    "merged_task_tables": sql(f"SELECT task_id, {_NEXT_STATUS} AS status FROM reconciled", "reconciled"),
    "expected_outputs": sql('SELECT task_id, grp AS "group", type, mask, n_files, size FROM totals', "totals"),
    "output_files": sql('SELECT task_id, grp AS "group", type, filepath, size FROM found', "found"),
    "output_sizes": sql("""
SELECT task_id, CAST(sum(size) AS BIGINT) AS output_files_size, CAST(sum(n_files) AS BIGINT) AS n_files,
       count(CASE WHEN n_files = 0 THEN 1 END) AS n_missing FROM totals GROUP BY 1""", "totals"),
    "missing_outputs": sql('SELECT task_id, grp AS "group", type, mask FROM totals WHERE n_files = 0', "totals"),
    "overlaid_outputs": sql("""
SELECT coalesce(t.task_id, s.task_id) AS task_id, coalesce(t.grp, s.grp) AS "group", coalesce(t.type, s.type) AS type,
       coalesce(s.value, t.value) AS value
FROM (SELECT task_id, grp, type, CAST(sum(size) AS VARCHAR) AS value FROM found GROUP BY 1, 2, 3) t
FULL OUTER JOIN (SELECT task_id, 'plots' AS grp, unnest(['page', 'summary']) AS type, CAST(n AS VARCHAR) AS value
                 FROM (SELECT task_id, count(*) AS n FROM listing GROUP BY 1)) s
ON t.task_id = s.task_id AND t.grp = s.grp AND t.type = s.type""", "found", "listing"),
    "rerun_list": sql("""
SELECT t.task_id, status, coalesce(n, 0) AS n_missing FROM tasks t
LEFT JOIN (SELECT task_id, count(*) AS n FROM totals WHERE n_files = 0 GROUP BY 1) m ON t.task_id = m.task_id
WHERE status = 'failed' OR (status = 'completed' AND n > 0)""", "tasks", "totals"),
    "shaped_inputs": sql(_shaped_inputs("pipeline_id"), "tasks"),
    "ruleless_inputs": sql(_shaped_inputs("CASE WHEN input_files_size % 3 <> 0 THEN pipeline_id END"), "tasks"),
    "unshaped_tasks": sql("""
SELECT task_id, 'no shaper' AS reason FROM tasks WHERE input_files_size % 3 = 0 OR pipeline_id = 'survey_v2-2-2'""", "tasks"),
    "shaped_outputs": sql("""
SELECT task_id, 'data' AS "group", 'bytes' AS type, CAST(input_files_size AS VARCHAR) AS value FROM tasks
WHERE status = 'completed' AND pipeline_id <> 'survey_v2-2-2'""", "tasks"),

    "debounced_events": sql(f"""
SELECT event_id, src_path, epoch_us(ts) AS ts_us FROM (
  SELECT *, lead(ts) OVER (PARTITION BY src_path ORDER BY ts, event_id) AS later FROM file_events)
WHERE later IS NULL OR epoch_us(later) - epoch_us(ts) > {_GAP}""", "file_events"),
    "event_sessions": sql(_sessions("src_path", "file_events", _GAP, ", CAST(sum(size) AS BIGINT) AS size"), "file_events"),
    "batch_holds": sql(_sessions("batch", "file_events", 600_000_000, ""), "file_events"),
    "settling_batches": sql("""
SELECT batch, modified >= epoch_us(TIMESTAMP '2001-07-31 23:55:00') AS debounce FROM new_batches""", "new_batches"),
    "state_transitions": sql("""
SELECT src_path AS task_id, epoch_us(ts) AS polled_us, before AS previous_status, event_type AS status FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY src_path ORDER BY ts) AS before FROM file_events)
WHERE before IS NULL OR before <> event_type""", "file_events"),

    "curation_needed": sql("""
SELECT batch, size, concat_ws(',', CASE WHEN pore IS NULL THEN 'pore' END,
       CASE WHEN experiment_type IS NULL THEN 'experiment_type' END) AS unknowns FROM held WHERE held""", "held"),
    "released_batches": sql("""
SELECT batch, coalesce(pore, 'R9') AS pore, experiment_type FROM held WHERE held AND experiment_type IS NOT NULL""", "held"),
    "chemistry_codes": sql("""
SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'r9.4.1' WHEN 'LARGE' THEN 'r10.4.1' END AS pore,
       CASE WHEN p_size > 25 THEN 'e8' WHEN p_size > 10 THEN 'e8.2' END AS chemistry FROM part"""),
    "sample_ready": sql("""
SELECT sample, count(*) AS n_batches, count(CASE WHEN held THEN 1 END) AS n_held, NOT bool_or(held) AS ready,
       CASE WHEN bool_or(held) THEN 'curation' ELSE 'indexed' END AS status
FROM (SELECT DISTINCT sample, batch FROM files) f JOIN held h ON f.batch = h.batch GROUP BY 1""", "files", "held"),
    "curated_sample_rollup": sql(_samples("clear_files"), "clear_files"),
    "run_groups": sql("""
SELECT sample, experiment_type, pore, count(*) AS n_files, CAST(sum(f.size) AS BIGINT) AS size
FROM files f JOIN held h ON f.batch = h.batch GROUP BY 1, 2, 3""", "files", "held"),
}

_BORN_OLD = """
SELECT o.symlink, CAST(0 AS BIGINT) AS born, o.fingerprint, o.size, o.filepath, n.symlink AS n_symlink,
       n.fingerprint AS n_fingerprint, n.filepath AS n_filepath
FROM active o LEFT JOIN files n ON o.symlink = n.symlink"""
_cte("pair", _BORN_OLD, "active", "files")
_cte("first_batches", """
SELECT batch, min(CASE WHEN report_type = 'final_summary' THEN r.filepath END) AS final_summary
FROM new_batches b LEFT JOIN reports r ON contains(string_split(r.filepath, '/')[-1], b.batch) GROUP BY 1""",
     "new_batches", "reports")
_cte("bursts", _sessions("src_path", "file_events", _GAP, ", arg_max(event_id, (ts, event_id)) AS event_id"), "file_events")
_cte("report_rows", """
SELECT '/r/new/final_summary_' || user_id || '.txt' AS filepath, ts, event_type NOT IN ('click', 'error') AS present FROM events
UNION ALL SELECT '/r/kept/final_summary_' || user_id || '.txt', ts, true FROM events WHERE event_type = 'click'""")
_REPORT_SET = "SELECT filepath FROM report_rows GROUP BY 1 HAVING arg_max(present, ts)"
_cte("cycle", f"""
SELECT task_id, {_NEXT_STATUS} AS status, sorting, input_files_size, minutes FROM reconciled
UNION ALL
SELECT c.sample_id || '_' || pipeline_id, CASE WHEN pipeline_id <> 'survey_v2-2-2' AND s.size > 0 THEN 'prepared'
         ELSE 'disprepared' END, {_TASK_RULE.format('SJF', 'LJF', 'SJF')}, s.size,
       CAST({_TASK_RULE.format(1605, 440, 0)} AS BIGINT)
FROM candidates c LEFT JOIN new_samples s ON c.sample_id = s.sample
WHERE c.sample_id IN (SELECT sample_id FROM results) AND NOT EXISTS (
  SELECT 1 FROM tasks t WHERE t.sample_id = c.sample_id AND t.pipeline_id = c.pipeline_id)""",
     "reconciled", "candidates", "new_samples", "results", "tasks")

ORACLE.update({
    "indexed_files": sql(f"""
SELECT symlink, born, CASE WHEN n_symlink IS NOT NULL AND n_fingerprint = fingerprint THEN n_filepath ELSE filepath END
         AS filepath, size,
       CASE WHEN n_symlink IS NULL THEN 'deleted' WHEN n_fingerprint <> fingerprint THEN 'deprecated' ELSE 'indexed' END
         AS status, '' AS previous_version,
       CASE WHEN n_fingerprint <> fingerprint THEN n_fingerprint END AS next_version,
       CASE WHEN n_symlink IS NULL THEN epoch_us({NOW}) END AS deleted_us FROM pair
UNION ALL
SELECT symlink, CAST(1 AS BIGINT), new_filepath, new_size, 'indexed', coalesce(old_fingerprint, ''), NULL, NULL
FROM diff WHERE change_type IN ('added', 'modified', 'moved_modified')""", "pair", "diff"),
    "indexed_batches": sql("""
SELECT o.batch, CAST(0 AS BIGINT) AS born, o.n_files, o.size,
       CASE WHEN n.batch IS NULL OR n.fingerprint <> o.fingerprint THEN 'deprecated' ELSE 'indexed' END AS status,
       o.fingerprint, '' AS previous_version, CASE WHEN n.fingerprint <> o.fingerprint THEN n.fingerprint END AS next_version,
       CASE WHEN n.fingerprint = o.fingerprint THEN f.final_summary END AS final_summary
FROM old_batches o LEFT JOIN new_batches n ON o.batch = n.batch LEFT JOIN first_batches f ON o.batch = f.batch
UNION ALL
SELECT n.batch, CAST(1 AS BIGINT), n.n_files, n.size, 'indexed', n.fingerprint, coalesce(o.fingerprint, ''), NULL,
       f.final_summary
FROM new_batches n LEFT JOIN old_batches o ON n.batch = o.batch LEFT JOIN first_batches f ON n.batch = f.batch
WHERE o.batch IS NULL OR n.fingerprint <> o.fingerprint""", "old_batches", "new_batches", "first_batches"),
    "indexed_samples": sql("""
SELECT sample, n_batches, n_files, size, fingerprint, sample || '_' || substr(fingerprint, 1, 6) AS sample_id,
       '/results/' || sample || '/' || substr(fingerprint, 1, 6) AS result_dir FROM new_samples""", "new_samples"),
    "scheduling_cycle": sql("""
SELECT c.task_id, c.status, c.sorting, CASE WHEN r."rank" <= CASE c.sorting WHEN 'SJF' THEN 150 ELSE 400 END
         - coalesce(in_use, 0) THEN r."rank" END AS "rank"
FROM cycle c
LEFT JOIN (SELECT task_id, row_number() OVER (PARTITION BY sorting
             ORDER BY CASE WHEN sorting = 'LJF' THEN -ratio ELSE ratio END NULLS LAST, task_id) AS "rank"
           FROM (SELECT *, CASE WHEN minutes > 0 THEN CAST(input_files_size AS DOUBLE) / minutes END AS ratio FROM cycle)
           WHERE status = 'prepared') r ON c.task_id = r.task_id
LEFT JOIN (SELECT sorting, count(*) AS in_use FROM cycle WHERE status IN ('queued', 'processing') GROUP BY 1) u
  ON c.sorting = u.sorting""", "cycle"),
    "event_diff": sql("""
SELECT symlink, change_type, new_filepath, new_size FROM diff
UNION ALL
SELECT '/links/fastq/B' || ((o_orderkey + 2000000000) % 40) || ':S' || o_custkey || ':' || (o_orderkey + 2000000000)
         || '.fastq.gz', 'unknown_deleted', NULL, NULL
FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'""", "diff"),
    "rejected_events": sql("""
SELECT '/links/fastq/B' || ((o_orderkey + 2000000000) % 40) || ':S' || o_custkey || ':' || (o_orderkey + 2000000000)
         || '.fastq.gz' AS symlink, 'deleted, not in catalog' AS reason
FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'"""),
    "stream_debounce": sql(
        "SELECT src_path, start_us, end_us AS settled_us, n_events, event_id FROM bursts", "bursts"),
    "stream_batch_holds": ORACLE["batch_holds"],
    "stream_sync": ORACLE["batch_rollup"],
    "stream_transitions": ORACLE["state_transitions"],
    "stream_entities": sql("""
SELECT batch AS name, n_files, size, 'stored' AS origin FROM new_batches
WHERE batch IN (SELECT batch FROM diff WHERE change_type NOT IN ('unchanged', 'moved'))""", "new_batches", "diff"),
    "report_set": sql(_REPORT_SET, "report_rows"),
    "stream_reports": sql(_REPORT_SET, "report_rows"),
})

_cte("untimed", "SELECT * REPLACE (CASE WHEN event_id % 5 <> 0 THEN ts END AS ts) FROM file_events", "file_events")
_cte("timed", "SELECT * FROM untimed WHERE ts IS NOT NULL", "untimed")
_cte("rules_met", """
SELECT sample_id, 'polish_v0-3-1' AS pipeline_id FROM samples WHERE status = 'indexed' AND kit_code < 20 AND name IS NOT NULL
UNION ALL
SELECT sample_id, 'assemble_v5-0-0' FROM samples WHERE status = 'indexed' AND size > 250000
  AND kit_name <> 'AUTOMOBILE' AND (batch_a IN ('B3', 'B9') OR batch_b IN ('B3', 'B9'))""", "samples")
_cte("ended", """
SELECT r.sample_id || '_' || pipeline_id AS task_id, r.sample_id, pipeline_id FROM rules_met r
JOIN new_samples s ON r.sample_id = s.sample
WHERE r.sample_id IN (SELECT sample_id FROM results) AND s.size > 0 AND CAST(substr(r.sample_id, 2) AS BIGINT) % 3 <> 0""",
     "rules_met", "new_samples", "results")

_cte("known_files", """
SELECT * FROM files WHERE batch IN (SELECT 'B' || n_nationkey FROM nation WHERE n_nationkey <> 7)""", "files")
_cte("rested_files", """
SELECT * FROM files WHERE batch IN (
  SELECT batch FROM new_batches WHERE modified < epoch_us(TIMESTAMP '2001-07-31 23:55:00'))""", "files", "new_batches")
_NAMED = "^([a-z]+)_(r[0-9.]+)_(e[0-9.]+)(_([0-9]+)bps)?_([a-z]+)@v([0-9.]+)$"
_cte("models", f"""
SELECT model, freq, regexp_extract(model, '{_NAMED}', 2) AS pore, regexp_extract(model, '{_NAMED}', 3) AS chemistry,
       regexp_extract(model, '{_NAMED}', 5) AS speed, regexp_extract(model, '{_NAMED}', 6) AS kind,
       [CAST(x AS INTEGER) FOR x IN string_split(regexp_extract(model, '{_NAMED}', 7), '.')] AS version
FROM (VALUES {', '.join(f"('{m}', '{f}')" for m, f, _ in MODELS)}) v(model, freq)""")
_cte("model_bases", "SELECT * FROM (VALUES " + ", ".join(
    f"('{m}', '{b}', '{v}')" for m, _, bases in MODELS for b, v in bases.items()) + ") v(model, modification, modification_version)")
_cte("model_runs", """
SELECT p_partkey, CASE WHEN p_size > 25 THEN 'r10.4.1' ELSE 'r9.4.1' END AS pore,
       CASE WHEN p_size > 25 THEN 'e8.2' ELSE 'e8' END AS chemistry,
       CASE WHEN p_size > 38 THEN '400' WHEN p_size > 25 THEN '260' ELSE '' END AS speed,
       ['fast', 'hac', 'sup'][p_partkey % 3 + 1] AS kind, ['5mCG', '6mA', '5mCG_5hmCG'][p_size % 3 + 1] AS modification,
       [CAST(3 + p_partkey % 3 AS INTEGER), CAST(p_size % 8 AS INTEGER)] AS version FROM part""")

ORACLE.update({
    "read_job_documents": sql(
        "SELECT job_id, parent_job_id, status, start_us FROM jobs WHERE job_id // 5000 % 7 <> 3", "jobs"),
    "damaged_job_documents": sql("""
SELECT DISTINCT job_id // 5000 AS document, 'no job listing' AS reason, '{"jobs":[' AS begins FROM jobs WHERE job_id // 5000 % 7 = 3""", "jobs"),
    "read_accounting_text": sql("""
SELECT CAST(job_id AS VARCHAR) AS job_id, status AS state, '0:0' AS exit_code FROM jobs WHERE job_id % 11 <> 4 AND job_id % 13 <> 5""", "jobs"),
    "damaged_accounting_lines": sql("""
SELECT CASE WHEN job_id % 11 = 4 THEN 'no state' ELSE 'no job number' END AS reason,
       CASE WHEN job_id % 11 = 4 THEN CAST(job_id AS VARCHAR) ELSE 'job' || job_id || ' ' || status END AS text
FROM jobs WHERE job_id % 11 = 4 OR job_id % 13 = 5""", "jobs"),
    "read_exit_code_files": sql("""
SELECT s_suppkey, CAST(CASE WHEN s_suppkey % 9 <> 5 THEN s_suppkey % 256 END AS INTEGER) AS exit_code FROM supplier"""),
    "damaged_exit_code_files": sql("""
SELECT s_suppkey, 'no exit code' AS reason, 'oops' AS text FROM supplier WHERE s_suppkey % 9 = 5"""),
    "reconcile_repeated": ORACLE["reconcile_tasks"],
    "stream_quiet_sync": sql("""
SELECT b.batch, b.n_files + coalesce(2 * n, 0) AS n_files, CAST(b.size + coalesce(s, 0) AS BIGINT) AS size FROM new_batches b
LEFT JOIN (SELECT 'B' || c_custkey % 40 AS batch, count(*) AS n, sum(2 * c_custkey + 30) AS s FROM customer GROUP BY 1) l
ON b.batch = l.batch""", "new_batches"),
    "listed_tree": sql("""
SELECT p_brand AS brand, 1 AS n_files, true AS with_content FROM part WHERE p_brand <> 'Brand#11' GROUP BY 1"""),
    "curated_passes": sql(f"SELECT sample, n_batches, n_files, size, fingerprint FROM ({_samples('known_files')})", "known_files"),
    "curations_kept": sql("""
SELECT batch, held, CASE WHEN n_nationkey IS NULL THEN 'pore,experiment_type' WHEN held THEN 'experiment_type' ELSE '' END AS unknowns,
       CASE WHEN r_name = 'ASIA' THEN 'v2' ELSE 'v1' END AS refs_version
FROM (SELECT b.batch, n_nationkey, r_name, n_nationkey IS NULL OR n_nationkey = 7 AS held FROM new_batches b
      LEFT JOIN nation ON b.batch = 'B' || n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)
WHERE held OR r_name = 'ASIA'""", "new_batches"),
    "resting_batches": sql(f"SELECT sample, n_batches, n_files, size FROM ({_samples('rested_files')})", "rested_files"),
    "model_lookup": sql("""
SELECT r.p_partkey, m.model, m.freq, r.modification, c.model AS calling, c.modification_version FROM model_runs r
LEFT JOIN (SELECT p_partkey, arg_max(model, m.version) AS model, arg_max(freq, m.version) AS freq
           FROM model_runs r JOIN models m USING (pore, chemistry, speed, kind) WHERE m.version <= r.version GROUP BY 1) m USING (p_partkey)
LEFT JOIN (SELECT p_partkey, arg_max(m.model, m.version) AS model, arg_max(b.modification_version, m.version) AS modification_version
           FROM model_runs r JOIN models m USING (pore, chemistry, speed, kind)
           JOIN model_bases b ON b.model = m.model AND b.modification = r.modification
           WHERE m.version <= r.version GROUP BY 1) c USING (p_partkey)""", "model_runs", "models", "model_bases"),
    "null_time_neighbours": sql("""
SELECT event_id, lag(event_id) OVER w AS before_id, lead(event_id) OVER w AS after_id FROM untimed
WINDOW w AS (PARTITION BY src_path ORDER BY ts NULLS FIRST, event_id)""", "untimed"),
    "null_time_settled": sql(f"""
SELECT event_id, src_path, epoch_us(ts) AS ts_us FROM (
  SELECT *, lead(ts) OVER (PARTITION BY src_path ORDER BY ts NULLS FIRST, event_id) AS later FROM untimed)
WHERE ts IS NULL OR later IS NULL OR epoch_us(later) - epoch_us(ts) > {_GAP}""", "untimed"),
    "null_time_sessions": sql(_sessions("src_path", "timed", _GAP, "") + """
UNION ALL SELECT src_path, NULL, NULL, count(*) FROM untimed WHERE ts IS NULL GROUP BY 1""", "timed", "untimed"),
    "queue_heads": sql("""
SELECT * FROM (
  SELECT task_id, sorting, row_number() OVER (PARTITION BY sorting
           ORDER BY CASE WHEN sorting = 'LJF' THEN -ratio ELSE ratio END NULLS LAST, task_id) AS "rank"
  FROM (SELECT *, CASE WHEN minutes > 0 THEN CAST(input_files_size AS DOUBLE) / minutes END AS ratio FROM tasks)
  WHERE status = 'prepared') WHERE "rank" <= CASE sorting WHEN 'SJF' THEN 2 ELSE 2000 END""", "tasks"),
    "long_timeouts": sql("""
SELECT o_orderkey, CAST(lpad(CAST(o_orderkey AS VARCHAR), 9, '1') AS BIGINT) * 1440 + o_custkey * 60 + 7 AS minutes FROM orders"""),
    "rejected_files": sql("""
SELECT '/loose/' || p_partkey || '.pod5' AS symlink, 'path names no sample' AS reason FROM part"""),
    "reports_over_passes": sql("""
SELECT b.batch, b.n_files, b.size + grown AS size,
       min(CASE WHEN report_type = 'final_summary' THEN filepath END) AS final_summary,
       min(CASE WHEN report_type = 'sequencing_summary' THEN filepath END) AS sequencing_summary
FROM (SELECT b.*, g.grown FROM new_batches b JOIN (
        SELECT batch, count(CASE WHEN ino % 7 = 0 THEN 1 END) AS grown FROM files GROUP BY 1) g ON b.batch = g.batch) b
LEFT JOIN reports r ON contains(string_split(r.filepath, '/')[-1], b.batch) GROUP BY 1, 2, 3""",
                               "new_batches", "files", "reports"),
    "renamed_in_batch": sql(f"""
SELECT '/links/pod5/B' || (o_orderkey % 40) || ':S' || o_custkey || ':done-' || o_orderkey || '.pod5' AS symlink,
       'added' AS change_type, '/src/S' || o_custkey || '/' || strftime(o_orderdate, '%Y%m%d') || '_1200_P1_B'
         || (o_orderkey % 40) || '/raw/done-' || o_orderkey || '.pod5' AS new_filepath, {_SIZE} AS new_size
FROM orders WHERE o_orderpriority <> '1-URGENT'
UNION ALL
SELECT '/links/' || CASE o_orderstatus WHEN 'F' THEN 'fast5' WHEN 'O' THEN 'pod5' ELSE 'fastq' END || '/B' || (o_orderkey % 40)
         || ':S' || o_custkey || ':' || o_orderkey || '.'
         || CASE o_orderstatus WHEN 'F' THEN 'fast5' WHEN 'O' THEN 'pod5' ELSE 'fastq.gz' END, 'deleted', NULL, NULL
FROM orders WHERE o_orderpriority = '3-MEDIUM' AND o_orderdate < {CATALOG_TIME}"""),
    "renamed_files": sql("""
SELECT CASE WHEN hit THEN symlink_dir || '/' || batch || ':T' || substr(sample, 2) || ':n-' || file ELSE symlink END AS symlink,
       CASE WHEN hit THEN replace(folder, '/src/S', '/src/T') || '/n-' || file ELSE filepath END AS filepath,
       CASE WHEN hit THEN batch || ':T' || substr(sample, 2) || ':n-' || file ELSE name END AS name, batch,
       CASE WHEN hit THEN 'T' || substr(sample, 2) ELSE sample END AS sample, extension,
       CASE WHEN hit THEN replace(folder, '/src/S', '/src/T') ELSE folder END AS directory, size, status
FROM (SELECT *, directory AS folder, (status IS NULL OR status = 'indexed') AND symlink IN (
        SELECT symlink FROM active WHERE size % 2 = 0) AS hit FROM catalog)""", "catalog", "active"),
    "completed_cycle": sql("""
SELECT task_id, pipeline_id, grp AS "group", type, value FROM (
  SELECT e.task_id, e.pipeline_id, s.grp, s.type, l.filepath AS value FROM ended e
  JOIN listing l ON e.task_id = 'S' || l.p_partkey || '_polish_v0-3-1'
  JOIN slots s ON regexp_matches(l.name, s.pattern) AND s.grp = 'tables'
  WHERE is_file AND l.size > 0 AND e.pipeline_id = 'polish_v0-3-1'
  UNION ALL
  SELECT task_id, pipeline_id, 'plots', 'page', 'shaped ' || sample_id FROM ended)""", "ended", "listing", "slots"),
})

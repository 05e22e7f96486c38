"""DuckDB SQL for the registered queries, derived from the fixture rules on
``customer`` (and nation, region, orders) directly: nothing here parses a
registry line, so a parsing mistake cannot hide on both sides.

Rules (see plans/fixtures.py): k = c_custkey; 4 files by k % 4 plus an empty
fifth; k%17 short line, k%19 bad id width, k%31 overwide cep, k%29 line
written twice, k%23 blank line after, k%41 LF ending, k%43/k%47 bad date,
k%53 padded name, k%37 three extra fields.
"""

from __future__ import annotations

from regline.layout import EMPRESAS


def _weights(n: int) -> list[int]:
    """The check-digit weights of ``n`` characters: 2 to 9 and again from 2, from the right."""
    return [2 + i % 8 for i in range(n)][::-1]


def _lp(expr: str, n: int) -> str:
    return f"lpad(CAST({expr} AS VARCHAR), {n}, '0')"


def _fields_select(source: str, release: str | None = None) -> str:
    name = "name"
    if release == "B":
        name = "CASE WHEN k % 7 = 0 THEN name || ' Ltda' ELSE name END"
    where = {"A": "WHERE k % 13 <> 0", "B": "WHERE k % 11 <> 0"}.get(release, "")
    return f"""
  SELECT k, nk, {name} AS name, bal FROM {source} {where}"""


def base_cte(release: str | None = None, taken: str = "reason IS NULL") -> str:
    """CTEs: src, f (field values), g (one row per key with line and class),
    lines (physical non-blank lines), rec (accepted records, with copies),
    recd (one record per key)."""
    pos = {
        0: "f0", 1: "f1", 2: "f2", 3: "f3", 4: "f4", 5: "f5", 6: "f6", 7: "f7", 10: "f10", 11: "f11",
        13: "f13", 14: "f14", 15: "f15", 19: "f19", 21: "f21", 22: "f22", 24: "f24", 29: "f29",
        32: "f32", 33: "'BR'", 36: "f36",
    }
    full = ", ".join(pos.get(i, "''") for i in range(37))
    first10 = ", ".join(pos.get(i, "''") for i in range(10))
    rec_cols = {
        "cnpj": "f0 || f1 || f2",
        "razao_social": "NULLIF(f4, '')",
        "cnae_fiscal": "NULLIF(f5, '')",
        "situacao_cadastral": "NULLIF(f14, '')",
        "data_situacao_cadastral": "NULLIF(f15, '')",
        "uf": "NULLIF(f32, '')",
        "codigo_municipio": "NULLIF(f21, '')",
        "cep": "NULLIF(f29, '')",
        "ddd_telefone_1": "NULLIF(f22, '')",
        "ddd_telefone_2": "NULLIF(f24, '')",
        "ddd_fax": "CAST(NULL AS VARCHAR)",
        "data_abertura": "NULLIF(f3, '')",
        "natureza_juridica": "NULLIF(f19, '')",
        "qualificacao_representante_legal": "NULLIF(f7, '')",
        "porte_empresa": "CAST(NULL AS VARCHAR)",
        "opcao_simples_nacional": "NULLIF(f10, '')",
        "data_opcao_simples_nacional": "NULLIF(f11, '')",
        "data_exclusao_simples_nacional": "CAST(NULL AS VARCHAR)",
        "opcao_mei": "NULLIF(f13, '')",
        "situacao_especial": "CAST(NULL AS VARCHAR)",
        "data_situacao_especial": "CAST(NULL AS VARCHAR)",
        "capital_social": "NULLIF(f36, '')",
    }
    assert list(rec_cols) == EMPRESAS.names
    rec_select = ", ".join(f"{expr} AS {name}" for name, expr in rec_cols.items())
    return f"""
WITH src AS ({_fields_select("(SELECT c_custkey AS k, c_name AS name, CAST(c_nationkey AS BIGINT) AS nk, c_acctbal AS bal FROM customer)", release)}
),
f AS (
  SELECT k, nk, name, bal,
    CASE WHEN k % 19 = 0 THEN substr({_lp('k', 8)}, 2, 7) ELSE {_lp('k', 8)} END AS f0,
    '0001' AS f1,
    {_lp('k % 100', 2)} AS f2,
    CASE WHEN k % 43 = 0 THEN '20201301' WHEN k % 47 = 0 THEN '00000000'
         ELSE strftime(DATE '1990-01-01' + CAST(k * 37 % 10000 AS INTEGER), '%Y%m%d') END AS f3,
    CASE WHEN k % 53 = 0 THEN ' São ' || name || '\\' || chr(9) ELSE 'São ' || name END AS f4,
    '620' || {_lp('k % 7', 4)} AS f5,
    '"' || CAST(k % 10 AS VARCHAR) || '"' AS f6,
    {_lp('k % 50', 2)} AS f7,
    CASE k % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'N' ELSE '' END AS f10,
    CASE WHEN k % 3 = 0 THEN '2007' || {_lp('k % 12 + 1', 2)} || '01' ELSE '' END AS f11,
    CASE WHEN k % 4 = 0 THEN 'S' ELSE 'N' END AS f13,
    {_lp('k % 5', 2)} AS f14,
    '2020' || {_lp('k % 12 + 1', 2)} || {_lp('k % 28 + 1', 2)} AS f15,
    {_lp('nk % 7', 4)} AS f19,
    {_lp('nk', 7)} AS f21,
    {_lp('k % 89 + 10', 2)} AS f22,
    CASE WHEN k % 2 = 0 THEN {_lp('k % 88 + 11', 2)} ELSE '' END AS f24,
    CASE WHEN k % 31 = 0 THEN {_lp('k', 9)} ELSE {_lp('k * 13 % 100000000', 8)} END AS f29,
    'U' || CAST(nk % 10 AS VARCHAR) AS f32,
    CAST(CAST(bal AS DECIMAL(15, 2)) AS VARCHAR) AS f36
  FROM src
),
g AS (
  SELECT *,
    'Empresas' || CAST(k % 4 AS VARCHAR) || '.csv' AS file_name,
    CASE WHEN k % 17 = 0 THEN concat_ws(';', {first10})
         WHEN k % 37 = 0 THEN concat_ws(';', {full}) || ';x37;x38;x39'
         ELSE concat_ws(';', {full}) END AS line,
    CASE WHEN k % 17 = 0 THEN 10 WHEN k % 37 = 0 THEN 40 ELSE 37 END AS n_fields,
    CASE WHEN k % 17 = 0 THEN 'too_few_fields' WHEN k % 19 = 0 THEN 'bad_cnpj_width'
         WHEN k % 31 = 0 THEN 'overwide' END AS reason,
    CASE WHEN k % 29 = 0 THEN 2 ELSE 1 END AS copies,
    CASE WHEN k % 41 = 0 THEN 1 ELSE 2 END AS eol
  FROM f
),
lines AS (
  SELECT * FROM g
  UNION ALL
  SELECT * FROM g WHERE k % 29 = 0
),
rec AS (
  SELECT {rec_select}, k FROM lines WHERE {taken}
),
recd AS (
  SELECT DISTINCT * FROM rec
)"""


R = EMPRESAS.names
R_LIST = ", ".join(R)


def _check_digit_sql(c: str) -> str:
    def v(i: int) -> str:
        return f"(ascii(substr({c}, {i}, 1)) - 48)"

    s1 = " + ".join(f"{v(i + 1)} * {w}" for i, w in enumerate(_weights(12)))
    d1 = f"(CASE WHEN ({s1}) % 11 < 2 THEN 0 ELSE 11 - ({s1}) % 11 END)"
    s2 = " + ".join(f"{v(i + 1)} * {w}" for i, w in enumerate(_weights(13)[:12]))
    s2 = f"{s2} + {d1} * {_weights(13)[12]}"
    d2 = f"(CASE WHEN ({s2}) % 11 < 2 THEN 0 ELSE 11 - ({s2}) % 11 END)"
    return (
        f"CASE WHEN {c} IS NULL THEN NULL "
        f"WHEN NOT regexp_matches({c}, '^[0-9A-Z]{{12}}[0-9]{{2}}$') THEN 'not_checkable' "
        f"WHEN {d1} = {v(13)} AND {d2} = {v(14)} THEN 'ok' ELSE 'bad' END"
    )


def _typed_sql(name: str, kind: str) -> str:
    if kind == "date":
        return f"CAST(try_strptime({name}, '%Y%m%d') AS DATE)"
    if kind == "flag":
        return f"CASE {name} WHEN 'S' THEN true WHEN 'N' THEN false END"
    if kind == "decimal":
        return f"TRY_CAST(replace({name}, ',', '.') AS DECIMAL(15, 2))"
    return name


def _escape_sql(c: str) -> str:
    return f"replace(replace(replace(replace({c}, '\\', '\\\\'), chr(9), '\\t'), chr(10), '\\n'), chr(13), '\\r')"


def _file_bytes_cte() -> str:
    return """,
file_bytes AS (
  SELECT file_name, CAST(sum(copies * (length(line) + eol) + CASE WHEN k % 23 = 0 THEN eol ELSE 0 END) AS BIGINT) AS bytes
  FROM g GROUP BY file_name
)"""


def _files_cte() -> str:
    return """,
files AS (
  SELECT file_name, bytes FROM file_bytes
  UNION ALL SELECT 'Empresas4.csv', CAST(0 AS BIGINT)
)"""


def oracle_sql() -> dict[str, str]:
    B = base_cte()
    typed_cols = ", ".join(f"{_typed_sql(f.name, f.kind)} AS {f.name}" for f in EMPRESAS.fields)
    cast_err = ", ".join(
        f"CASE WHEN {f.name} IS NOT NULL AND {_typed_sql(f.name, f.kind)} IS NULL THEN '{f.name}' END"
        for f in EMPRESAS.fields
        if f.kind != "string"
    )
    copy_line = " || chr(9) || ".join(f"coalesce({_escape_sql(c)}, '\\N')" for c in R)
    null_counts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM rec" for c in R
    )
    per_reason = ", ".join(
        f"CAST(count(*) FILTER (WHERE reason = '{r}') AS BIGINT) AS {r}"
        for r in ("too_few_fields", "bad_cnpj_width", "overwide")
    )
    q: dict[str, str] = {}

    q["raw_line_scan"] = B + "\nSELECT file_name, line FROM lines"
    q["zip_archive_scan"] = q["raw_line_scan"]
    q["drop_blank_lines"] = B + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM g WHERE k % 23 = 0) AS blank_lines,
       CAST(count(*) AS BIGINT) AS kept_lines, CAST(0 AS BIGINT) AS space_lines FROM lines"""
    q["multi_file_scan"] = B + """
SELECT file_name, 'ok' AS status, CAST(count(*) AS BIGINT) AS lines FROM lines GROUP BY file_name
UNION ALL SELECT 'Empresas4.csv', 'ok', CAST(0 AS BIGINT)
UNION ALL SELECT 'Empresas9.csv', 'missing', CAST(0 AS BIGINT)"""
    q["dataset_file_selection"] = B + """
SELECT file_name, 'Empresas' AS dataset, CAST(substr(file_name, 9, 1) AS INTEGER) AS part_no,
       file_name IN ('Empresas1.csv', 'Empresas3.csv') AS selected
FROM (SELECT DISTINCT file_name FROM g UNION SELECT 'Empresas4.csv')"""
    q["archive_audit"] = B + _file_bytes_cte() + """
SELECT replace(file_name, '.csv', '.zip') AS archive, true AS is_zip, CAST(2 AS BIGINT) AS members,
       CAST(1 AS BIGINT) AS csv_members, bytes + 19 AS total_bytes, 'ok' AS verdict FROM file_bytes
UNION ALL SELECT 'Empresas4.zip', true, 1, 1, 0, 'ok'
UNION ALL SELECT 'Corrompido.zip', false, 0, 0, 0, 'not_zip'"""
    q["sha256_verify"] = B + """
SELECT file_name, CASE file_name WHEN 'Empresas1.csv' THEN 'mismatch' WHEN 'Empresas3.csv' THEN 'ok' ELSE 'unchecked' END AS status
FROM (SELECT DISTINCT file_name FROM g UNION SELECT 'Empresas4.csv')
UNION ALL SELECT 'Empresas9.csv', 'missing'"""
    q["skip_already_ingested"] = B + """
SELECT file_name FROM (SELECT DISTINCT file_name FROM g UNION SELECT 'Empresas4.csv')
WHERE file_name NOT IN ('Empresas0.csv', 'Empresas1.csv')"""
    q["split_fields"] = B + "\nSELECT n_fields, CAST(count(*) AS BIGINT) AS lines FROM lines GROUP BY n_fields"
    q["assemble_cnpj"] = B + "\nSELECT f0 || f1 || f2 AS cnpj FROM lines WHERE k % 17 <> 0 AND k % 19 <> 0"
    q["project_record"] = B + f"\nSELECT {R_LIST} FROM rec"
    q["empty_to_null"] = B + "\n" + null_counts
    q["trim_field"] = B + "\nSELECT cnpj, NULLIF(trim(razao_social, ' ' || chr(9)), '') AS razao_social FROM rec"
    q["decode_text"] = B + """
SELECT cnpj, razao_social, CAST(length(razao_social) AS BIGINT) AS chars,
       CAST(strlen(razao_social) AS BIGINT) AS utf8_bytes FROM rec"""
    q["min_field_count"] = B + "\nSELECT file_name, line, n_fields FROM lines WHERE reason = 'too_few_fields'"
    q["cnpj_part_widths"] = B + "\nSELECT file_name, line FROM lines WHERE reason = 'bad_cnpj_width'"
    q["reject_routing"] = B + """
SELECT coalesce(reason, 'accepted') AS reason, CAST(count(*) AS BIGINT) AS lines FROM lines
GROUP BY coalesce(reason, 'accepted')"""
    q["column_width_check"] = B + "\nSELECT f0 || f1 || f2 AS cnpj, 'cep' AS detail FROM lines WHERE reason = 'overwide'"
    q["primary_key_check"] = B + """
SELECT cnpj, CAST(count(*) AS BIGINT) AS copies FROM rec GROUP BY cnpj HAVING count(*) > 1"""
    q["primary_key_dedupe"] = B + "\nSELECT cnpj, razao_social, uf FROM recd"
    q["ingest_table"] = B + f"\nSELECT {R_LIST} FROM recd"
    q["table_append"] = q["ingest_table"]
    q["ensure_table"] = B + """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT uf) AS BIGINT) AS ufs,
       CAST(22 AS BIGINT) AS columns FROM recd"""
    q["copy_text_export"] = B + f"\nSELECT {copy_line} AS line FROM recd"
    q["layout_and_statistics"] = B + """
SELECT c AS column_name, (SELECT CAST(count(*) AS BIGINT) FROM recd) AS rows, CAST(nulls AS BIGINT) AS nulls, true AS has_values,
       (SELECT CAST(count(*) AS INTEGER) FROM recd WHERE uf = 'U3' AND cnae_fiscal = '6200003') AS hits
FROM (SELECT 'uf' AS c, count(*) - count(uf) AS nulls FROM recd
      UNION ALL SELECT 'cnae_fiscal', count(*) - count(cnae_fiscal) FROM recd
      UNION ALL SELECT 'situacao_cadastral', count(*) - count(situacao_cadastral) FROM recd)"""
    q["bounded_output_chunks"] = B + """
SELECT CAST(count(*) AS BIGINT) AS records, CAST(0 AS BIGINT) AS oversize_files FROM recd"""
    q["exact_chunks"] = B + """,
placed AS (SELECT cnpj, (row_number() OVER (ORDER BY cnpj) - 1) // 50 AS chunk FROM recd)
SELECT CAST(chunk AS BIGINT) AS chunk, CAST(count(*) AS BIGINT) AS rows, min(cnpj) AS first_cnpj, max(cnpj) AS last_cnpj,
       CAST(1 AS BIGINT) AS files
FROM placed GROUP BY chunk"""
    sent = base_cte(taken="reason IS NULL OR reason = 'overwide'") + """,
placed AS (SELECT *, (row_number() OVER (ORDER BY cnpj) - 1) // 15 AS batch FROM recd),
judged AS (SELECT *, bool_or(length(cep) > 8) OVER (PARTITION BY batch) AS refused FROM placed)
"""
    q["sink_batches"] = sent + """
SELECT CAST(batch AS BIGINT) AS batch, CAST(count(*) AS BIGINT) AS rows, NOT refused AS sent,
       CASE WHEN refused THEN 'cep' END AS error
FROM judged GROUP BY batch, refused"""
    q["sink_counters"] = sent + """
SELECT CAST(count(DISTINCT batch) FILTER (WHERE NOT refused) AS BIGINT) AS batches_sent,
       CAST(count(DISTINCT batch) FILTER (WHERE refused) AS BIGINT) AS batches_failed,
       CAST(count(*) FILTER (WHERE NOT refused) AS BIGINT) AS records_written,
       CAST(count(*) FILTER (WHERE refused) AS BIGINT) AS records_refused
FROM judged"""
    q["sink_rows"] = sent + f"\nSELECT {R_LIST} FROM judged WHERE NOT refused"
    q["import_counters"] = B + _file_bytes_cte() + f""",
w AS (SELECT CAST(count(*) AS BIGINT) AS n FROM recd)
SELECT CAST(count(*) AS BIGINT) AS lines_read,
       CAST(count(*) FILTER (WHERE reason IS NULL) AS BIGINT) AS records_processed,
       CAST(count(*) FILTER (WHERE reason = 'too_few_fields') AS BIGINT) AS rejected_too_few_fields,
       CAST(count(*) FILTER (WHERE reason = 'bad_cnpj_width') AS BIGINT) AS rejected_bad_cnpj_width,
       CAST(count(*) FILTER (WHERE reason = 'overwide') AS BIGINT) AS rejected_overwide,
       CAST(count(*) FILTER (WHERE reason IS NULL) - (SELECT n FROM w) AS BIGINT) AS duplicates_dropped,
       (SELECT n FROM w) AS records_written,
       CAST(5 AS BIGINT) AS files_read, CAST(0 AS BIGINT) AS files_failed,
       (SELECT CAST(sum(bytes) AS BIGINT) FROM file_bytes) AS bytes_read,
       CAST(ceil(count(*) FILTER (WHERE reason IS NULL) / 100.0) AS BIGINT) AS batches_sent,
       CAST(0 AS BIGINT) AS records_filtered, CAST(0 AS BIGINT) AS already_stored, CAST(0 AS BIGINT) AS files_left_out,
       CAST(count(*) FILTER (WHERE reason IS NOT NULL) AS BIGINT) AS errors
FROM lines"""
    # The archives hold the same bytes, unpacked; one file among them is no archive.
    q["import_counters_zip"] = q["import_counters"].replace("CAST(0 AS BIGINT) AS files_failed", "CAST(1 AS BIGINT) AS files_failed").replace(
        "CAST(count(*) FILTER (WHERE reason IS NOT NULL) AS BIGINT) AS errors",
        "CAST(count(*) FILTER (WHERE reason IS NOT NULL) + 1 AS BIGINT) AS errors",
    )
    q["throughput_rates"] = B + """
SELECT CAST(count(*) AS BIGINT) AS records_written, true AS took_time, true AS records_rate_follows,
       true AS mb_rate_follows, true AS no_time_gives_zero FROM recd"""
    q["cache_listing"] = B + """
SELECT replace(file_name, '.csv', '.zip') AS file_name, true AS size_in_mib
FROM (SELECT DISTINCT file_name FROM g UNION SELECT 'Empresas4.csv' UNION SELECT 'Corrompido.csv')"""
    q["ingest_zip"] = q["ingest_mixed"] = q["ingest_table"]
    # Files 0 and 1 come first; 2, 3 and the empty one are new the second time, and nothing is the third.
    q["ingest_twice"] = B + f"""
SELECT {R_LIST}, CAST(3 AS BIGINT) AS second_files_read, CAST(0 AS BIGINT) AS again_written FROM recd"""
    # File 1 and the archive fail; a key's lines are all in one file.
    q["ingest_unreadable"] = B + """
SELECT file_name, (SELECT CAST(count(DISTINCT cnpj) AS BIGINT) FROM rec WHERE k % 4 <> 1) AS records_written,
       CAST(3 AS BIGINT) AS files_read, CAST(2 AS BIGINT) AS files_failed
FROM (SELECT DISTINCT file_name FROM g WHERE file_name <> 'Empresas1.csv')"""
    q["key_index"] = B + "\nSELECT cnpj, CAST(1 AS BIGINT) AS entries FROM recd"
    q["stored_key_lookup"] = B + """
SELECT cnpj, bool_or(k % 4 IN (0, 1)) AS stored FROM rec GROUP BY cnpj"""
    q["per_file_report"] = B + _file_bytes_cte() + _files_cte() + f""",
per AS (
  SELECT file_name, CAST(count(*) AS BIGINT) AS lines,
         CAST(count(*) FILTER (WHERE reason IS NULL) AS BIGINT) AS accepted, {per_reason}
  FROM lines GROUP BY file_name
)
SELECT files.file_name, files.bytes, coalesce(lines, 0) AS lines, coalesce(accepted, 0) AS accepted,
       coalesce(too_few_fields, 0) AS too_few_fields, coalesce(bad_cnpj_width, 0) AS bad_cnpj_width,
       coalesce(overwide, 0) AS overwide
FROM files LEFT JOIN per USING (file_name)"""
    q["cnpj_check_digit"] = B + f"\nSELECT cnpj, {_check_digit_sql('cnpj')} AS dv_status FROM recd"
    q["typed_view"] = B + f"""
SELECT {typed_cols}, NULLIF(concat_ws(',', {cast_err}), '') AS cast_errors FROM recd"""
    q["record_filter"] = B + """
SELECT cnpj, razao_social, situacao_cadastral, opcao_mei FROM rec
WHERE situacao_cadastral = '02' AND opcao_mei = 'S'"""
    q["code_table_enrichment"] = B + """
SELECT cnpj, codigo_municipio, m.description AS municipio, natureza_juridica, n.description AS natureza,
       cnae_fiscal, c.description AS cnae, qualificacao_representante_legal, q.description AS qualificacao
FROM recd
LEFT JOIN (SELECT lpad(CAST(n_nationkey AS VARCHAR), 7, '0') AS code, 'Município ' || n_name AS description FROM nation) m
  ON recd.codigo_municipio = m.code
LEFT JOIN (SELECT lpad(CAST(r_regionkey AS VARCHAR), 4, '0') AS code, 'Natureza ' || r_name AS description FROM region) n
  ON recd.natureza_juridica = n.code
LEFT JOIN (SELECT '620' || lpad(CAST(r_regionkey AS VARCHAR), 4, '0') AS code, 'CNAE ' || r_name AS description FROM region) c
  ON recd.cnae_fiscal = c.code
LEFT JOIN (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, 'Qualificação ' || n_name AS description FROM nation) q
  ON recd.qualificacao_representante_legal = q.code"""
    q["code_table_unknown"] = B + """
SELECT 'natureza_juridica' AS code_column, natureza_juridica AS code, CAST(count(*) AS BIGINT) AS records
FROM recd WHERE natureza_juridica NOT IN (SELECT lpad(CAST(r_regionkey AS VARCHAR), 4, '0') FROM region)
GROUP BY natureza_juridica
UNION ALL
SELECT 'codigo_municipio', codigo_municipio, CAST(count(*) AS BIGINT)
FROM recd WHERE codigo_municipio NOT IN (SELECT lpad(CAST(n_nationkey AS VARCHAR), 7, '0') FROM nation)
GROUP BY codigo_municipio
UNION ALL
SELECT 'cnae_fiscal', cnae_fiscal, CAST(count(*) AS BIGINT)
FROM recd WHERE cnae_fiscal NOT IN (SELECT '620' || lpad(CAST(r_regionkey AS VARCHAR), 4, '0') FROM region)
GROUP BY cnae_fiscal
UNION ALL
SELECT 'qualificacao_representante_legal', qualificacao_representante_legal, CAST(count(*) AS BIGINT)
FROM recd WHERE qualificacao_representante_legal NOT IN (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') FROM nation)
GROUP BY qualificacao_representante_legal"""
    q["count_by_code"] = B + "\nSELECT uf, CAST(count(*) AS BIGINT) AS total FROM recd GROUP BY uf"
    q["count_by_situacao"] = B + """
SELECT situacao_cadastral, CAST(count(*) AS BIGINT) AS total FROM recd GROUP BY situacao_cadastral"""
    q["lookup_by_cnpj"] = B + """,
ids AS (
  SELECT DISTINCT lpad(CAST(o_custkey AS VARCHAR), 8, '0') || '0001' || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') AS cnpj
  FROM orders
)
SELECT ids.cnpj, recd.cnpj IS NOT NULL AS found, recd.razao_social, recd.uf
FROM ids LEFT JOIN recd ON ids.cnpj = recd.cnpj"""
    q["search_and_page"] = B + """
SELECT cnpj, razao_social, uf FROM recd
WHERE uf = 'U3' AND lower(razao_social) LIKE '%customer#%'
ORDER BY cnpj LIMIT 20 OFFSET 20"""
    q["file_export_parquet"] = q["ingest_table"]
    q["file_export_csv"] = q["ingest_table"]
    q["multi_sink_fanout"] = B + """
SELECT fmt AS format, (SELECT CAST(count(*) AS BIGINT) FROM recd) AS rows
FROM (VALUES ('parquet'), ('csv'), ('json')) t(fmt)"""
    q["multi_sink_fanout_rows"] = B + f"""
SELECT fmt AS format, {R_LIST} FROM recd JOIN (VALUES ('parquet'), ('csv'), ('json')) t(fmt) ON true"""
    A, Bn = base_cte("A"), base_cte("B")
    q["release_diff"] = f"""
WITH a AS ({A}
SELECT cnpj, razao_social FROM recd),
b AS ({Bn}
SELECT cnpj, razao_social FROM recd)
SELECT coalesce(a.cnpj, b.cnpj) AS cnpj,
  CASE WHEN a.cnpj IS NULL THEN 'inserted' WHEN b.cnpj IS NULL THEN 'deleted'
       WHEN a.razao_social = b.razao_social THEN 'unchanged' ELSE 'updated' END AS change
FROM a FULL JOIN b ON a.cnpj = b.cnpj"""
    q["apply_diff"] = q["apply_in_place"] = Bn + f"\nSELECT {R_LIST} FROM recd"
    q["incremental_file_ingest"] = q["incremental_archives"] = q["ingest_table"]
    q["batch_and_stream"] = B + f"\nSELECT {R_LIST}, CAST(0 AS BIGINT) AS again_written FROM recd"
    q["stream_quarantine"] = B + "\nSELECT file_name, line, reason FROM lines WHERE reason IS NOT NULL"
    q["stream_counters"] = B + _file_bytes_cte() + """,
w AS (SELECT CAST(count(*) AS BIGINT) AS n FROM recd),
sent AS (SELECT ceil(count(*) / 100.0) AS n FROM lines WHERE reason IS NULL GROUP BY file_name)
SELECT CAST(count(*) AS BIGINT) AS lines_read,
       CAST(count(*) FILTER (WHERE reason IS NULL) AS BIGINT) AS records_processed,
       CAST(count(*) FILTER (WHERE reason = 'too_few_fields') AS BIGINT) AS rejected_too_few_fields,
       CAST(count(*) FILTER (WHERE reason = 'bad_cnpj_width') AS BIGINT) AS rejected_bad_cnpj_width,
       CAST(count(*) FILTER (WHERE reason = 'overwide') AS BIGINT) AS rejected_overwide,
       CAST(count(*) FILTER (WHERE reason IS NULL) - (SELECT n FROM w) AS BIGINT) AS copies,
       (SELECT n FROM w) AS records_written,
       CAST(4 AS BIGINT) AS files_read, CAST(0 AS BIGINT) AS files_failed,
       (SELECT CAST(sum(bytes) AS BIGINT) FROM file_bytes) AS bytes_read,
       (SELECT CAST(sum(n) AS BIGINT) FROM sent) AS batches_sent,
       CAST(0 AS BIGINT) AS records_filtered, CAST(0 AS BIGINT) AS files_left_out,
       CAST(count(*) FILTER (WHERE reason IS NOT NULL) AS BIGINT) AS errors
FROM lines"""
    q["bounded_intake"] = B + """
SELECT CAST(4 AS BIGINT) AS batches, CAST(count(*) AS BIGINT) AS records FROM recd"""
    return q

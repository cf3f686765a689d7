"""For each query, SQL for DuckDB with the same result, written apart from the Spark code."""

from __future__ import annotations

from catalog.tables import BROKEN, FOOTERS, FURNISHED, JUNK, LEXICON, LISTING, LOSSY, PAIRS

NL = "chr(10)"
TAGGED = "'<' || lang || '> ' || raw"
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
# white space of every kind, as code points
SPACES = " || ".join(
    f"chr({c})" for c in (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
)


def byte_ids(text: str, budget: int | None = None) -> str:
    body = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::INT + 3)"
    if budget is not None:
        body = f"({body})[1:{budget - 1}]"
    return f"list_append({body}, 1)"


def digest(ids: str) -> str:
    return f"md5(array_to_string({ids}, ','))"


def numbered(seed: int = 42) -> str:
    return f"row_number() OVER (ORDER BY md5('{seed}:' || doc_id), doc_id)"


def split_side(cap: str) -> str:
    return f"""ordered AS (
        SELECT *, {numbered()} AS r, ceil(count(*) OVER () * 0.3::DOUBLE)::BIGINT AS n_val FROM pairs
    ), sided AS (
        SELECT *, CASE WHEN r <= least(n_val, {cap}) THEN 'val' WHEN r <= n_val THEN 'dropped' ELSE 'train' END AS split
        FROM ordered
    )"""


BATCHED = f"""{PAIRS}, sized AS (
    SELECT doc_id, {TAGGED} AS source_text, clean, least(strlen({TAGGED}) + 1, 4096) AS n_in,
        least(strlen(clean) + 1, 512) AS n_lab, ({numbered()} - 1) // 80 AS mega_id
    FROM pairs
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY mega_id ORDER BY n_in DESC, doc_id) - 1 AS p FROM sized
), batched AS (
    SELECT *, mega_id * 10 + p // 8 AS batch_id, p % 8 AS pos FROM placed
), widths AS (
    SELECT batch_id, count(*) AS n_rows, (max(n_in) + 7) // 8 * 8 AS w_in, (max(n_lab) + 7) // 8 * 8 AS w_lab,
        sum(n_in)::BIGINT AS s_in, sum(n_lab)::BIGINT AS s_lab
    FROM batched GROUP BY batch_id
), padded AS (
    SELECT doc_id, batch_id, pos,
        {byte_ids('source_text', 4096)} || list_transform(range(n_in, w_in), lambda i: 0) AS input_ids,
        list_transform(range(0, w_in), lambda i: (i < n_in)::INT) AS mask,
        {byte_ids('clean', 512)} || list_transform(range(n_lab, w_lab), lambda i: -100) AS label_ids
    FROM batched JOIN widths USING (batch_id)
)"""

NUMBERS = "'[0-9]+(?:[.,][0-9]+)*'"
ITEMS = r"'(?m)^[ \t]*(?:[-*+•‣▪]|[0-9]{1,3}[.)])[ \t]+[^ \t\n]'"
ROWS = r"'(?m)^[^|\n]*\|[^|\n]*\|'"


def item_excess(items: str, other: str, table: str) -> str:
    """Per doc_id, how many more of each item there are than of its equals, summed."""
    return f"""SELECT doc_id, coalesce(sum(greatest(n - m, 0)), 0)::BIGINT AS excess FROM (
        SELECT doc_id, item, sum(a) AS n, sum(b) AS m FROM (
            SELECT doc_id, unnest({items}) AS item, 1 AS a, 0 AS b FROM {table}
            UNION ALL SELECT doc_id, unnest({other}), 0, 1 FROM {table})
        GROUP BY doc_id, item) GROUP BY doc_id"""


def regex_all(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, {pattern})"


def lines(text: str) -> str:
    return f"string_split({text}, {NL})"


def keep_lines(text: str, pattern: str) -> str:
    kept = f"list_filter({lines(text)}, lambda l: NOT regexp_matches(trim(l, {SPACES}), '(?i){pattern}'))"
    return f"coalesce(array_to_string({kept}, {NL}), '')"


# the furniture that the texts were given, and no line of theirs is
UNFURNISHED = (
    f"CASE lang WHEN 'en' THEN {keep_lines('text', r'^(home [|] search|back to top|[(]c[)] 2001 [|] all rights reserved[.])$')}"
    f" WHEN 'id' THEN {keep_lines('text', r'^(beranda|kembali ke atas|hak cipta 2001)$')} ELSE text END"
)

LAST_LINE = f"trim(list_last({lines(f'rtrim(raw, {SPACES})')}), {SPACES})"

STRUCTURE = f"""measured AS (
    SELECT *, len({regex_all('raw', ITEMS)}) AS items_raw, len({regex_all('clean', ITEMS)}) AS items_clean,
        len({regex_all('raw', ROWS)}) AS rows_raw, len({regex_all('clean', ROWS)}) AS rows_clean
    FROM lossy
)"""

FINDINGS = f"""{FOOTERS}, gaps AS (
    SELECT dataset, count(*) AS n FROM (
        SELECT dataset, unnest(range(0, max(idx) + 1)) AS idx FROM shards WHERE valid GROUP BY dataset
        EXCEPT SELECT dataset, idx FROM shards WHERE valid) GROUP BY dataset
), doubles AS (
    SELECT DISTINCT dataset FROM shards WHERE valid GROUP BY dataset, idx HAVING count(*) > 1
), totals AS (
    SELECT dataset, of_m FROM shards WHERE valid GROUP BY dataset, of_m
    HAVING of_m <> (SELECT count(*) FROM shards s WHERE s.valid AND s.dataset = shards.dataset)
), kinds AS (
    SELECT dataset, count(DISTINCT kind) AS n_kinds, min(kind) AS kind, sum(n_rows) AS total
    FROM footers WHERE kind IN ('tok', 'raw') GROUP BY dataset
), findings AS (
    SELECT DISTINCT dataset, 1 AS step, 'tmp_shards' AS ck, 'fail' AS severity, dataset AS subject
    FROM listing WHERE starts_with(name, 'tmp-')
    UNION ALL (SELECT dataset, 2, 'stray_files', 'fail', name FROM listing WHERE dataset = 'es' ORDER BY name LIMIT 5)
    UNION ALL SELECT DISTINCT dataset, 3, 'shard_names', 'fail', dataset FROM shards WHERE NOT valid
    UNION ALL SELECT dataset, 4, 'shard_gaps', 'fail', dataset FROM gaps
    UNION ALL SELECT dataset, 4, 'shard_duplicates', 'fail', dataset FROM doubles
    UNION ALL SELECT dataset, 4, 'shard_total_mismatch', 'fail', dataset FROM totals
    UNION ALL SELECT dataset, 5, 'corrupt_shards', 'fail', path FROM footers WHERE error IS NOT NULL
    UNION ALL SELECT dataset, 5, 'unknown_schema', 'fail', path FROM footers WHERE kind = 'unknown'
    UNION ALL SELECT dataset, 6, 'mixed_schema', 'fail', dataset FROM kinds WHERE n_kinds > 1
    UNION ALL SELECT dataset, 7, 'expected_rows', CASE kind WHEN 'tok' THEN 'info' ELSE 'warn' END, dataset FROM kinds
    WHERE n_kinds = 1 AND (kind = 'tok' OR total <> 1431369)
)"""

ORACLES = {
    "scan_pairs": f"WITH {PAIRS} SELECT doc_id, lang, md5(raw) AS raw_md5, md5(clean) AS clean_md5 FROM pairs",
    "list_shards": """WITH n AS (SELECT (count(*) + 499) // 500 AS m FROM documents)
        SELECT format('train-{:05d}-of-{:05d}.parquet', i, m) AS name, true AS top_level
        FROM (SELECT m, unnest(range(greatest(m, 1))) AS i FROM n)""",
    "scan_footers": " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS name, (SELECT count(*) FROM {t}) AS n_rows,"
        f" (SELECT count(*) FROM (DESCRIBE {t})) AS n_cols, true AS readable"
        for t in TABLES
    ),
    "write_prepared": f"""WITH {PAIRS}, {split_side('200')}
        SELECT split, count(*) AS n_rows, sum(least(strlen({TAGGED}) + 1, 4096))::BIGINT AS input_tokens,
            sum(least(strlen(clean) + 1, 512))::BIGINT AS label_tokens
        FROM sided WHERE split <> 'dropped' GROUP BY split""",
    "classify_schema": f"WITH {FOOTERS} SELECT path, kind FROM footers",
    "validate_rows": f"""WITH {BROKEN}, judged AS (
        SELECT doc_id, concat_ws(',',
            CASE WHEN lang IS NULL THEN 'lang_missing' WHEN lang NOT IN ('id', 'en', 'zh') THEN 'lang_unsupported' END,
            CASE WHEN raw IS NULL THEN 'raw_missing' END,
            CASE WHEN clean IS NULL THEN 'clean_missing' END) AS reasons
        FROM broken) SELECT doc_id, reasons = '' AS valid, reasons FROM judged""",
    "invalid_counts": f"""WITH {BROKEN}
        SELECT * FROM (
            SELECT 'lang_missing' AS reason, count(*) FILTER (lang IS NULL) AS n_rows FROM broken
            UNION ALL SELECT 'lang_unsupported', count(*) FILTER (lang NOT IN ('id', 'en', 'zh')) FROM broken
            UNION ALL SELECT 'raw_missing', count(*) FILTER (raw IS NULL) FROM broken
            UNION ALL SELECT 'clean_missing', count(*) FILTER (clean IS NULL) FROM broken) WHERE n_rows > 0""",
    "lang_prefix": f"WITH {PAIRS} SELECT doc_id, md5({TAGGED}) AS prefixed_md5 FROM pairs",
    "tokenize": f"""WITH {PAIRS} SELECT doc_id, {digest(byte_ids(TAGGED))} AS input_digest,
        {digest(byte_ids('clean'))} AS label_digest FROM pairs""",
    "token_length": f"WITH {PAIRS} SELECT doc_id, least(strlen({TAGGED}) + 1, 4096)::BIGINT AS length FROM pairs",
    "budget_flags": f"""WITH {PAIRS} SELECT doc_id, strlen({TAGGED}) + 1 > 4096 AS is_input_truncated,
        strlen(clean) + 1 > 512 AS is_target_truncated FROM pairs""",
    "truncate_to_budget": f"""WITH {PAIRS} SELECT doc_id, least(strlen({TAGGED}) + 1, 4096)::BIGINT AS n_input,
        least(strlen(clean) + 1, 512)::BIGINT AS n_label,
        {digest(byte_ids(TAGGED, 4096))} AS input_digest, {digest(byte_ids('clean', 512))} AS label_digest,
        strlen({TAGGED}) >= 4096 AS is_input_truncated, strlen(clean) >= 512 AS is_target_truncated FROM pairs""",
    "truncation_counts": f"""WITH {PAIRS}, f AS (
        SELECT lang, strlen({TAGGED}) >= 4096 AS a, strlen(clean) >= 512 AS b FROM pairs)
        SELECT lang, false AS is_total, count(*) AS n_rows, count(*) FILTER (a) AS input_truncated,
            count(*) FILTER (b) AS target_truncated FROM f GROUP BY lang
        UNION ALL SELECT NULL, true, count(*), count(*) FILTER (a), count(*) FILTER (b) FROM f""",
    "skip_over_budget": f"""WITH {PAIRS} SELECT doc_id, md5(raw) AS raw_md5, md5(clean) AS clean_md5 FROM pairs
        WHERE strlen({TAGGED}) < 4096 AND strlen(clean) < 512""",
    "reject_over_budget": f"""WITH t AS (
            SELECT doc_id, lang, CASE source WHEN 'src1' THEN '' WHEN 'src2' THEN NULL ELSE text END AS raw FROM documents
        ), s AS (SELECT *, strlen({TAGGED}) + 1 AS n FROM t)
        SELECT doc_id, n::BIGINT AS n_tokens, CASE WHEN raw IS NULL THEN 'bad_text'
            WHEN lang NOT IN ('en', 'fr', 'de') THEN 'bad_lang' WHEN raw = '' THEN 'empty'
            WHEN n > 4096 THEN 'over_budget' ELSE 'ok' END AS status FROM s""",
    # the lines that cleaning kept are the matched ones; dropped ones stay with the kept line before them
    "chunk_pairs": f"""WITH RECURSIVE {PAIRS}, split AS (
            SELECT doc_id, lang, raw, {lines('raw')} AS rl, {lines('clean')} AS cl,
                list_transform({lines('clean')}, lambda l: NOT (lang = 'es' AND regexp_matches(l, '(?i)licen[sc]e|rights reserved'))) AS kept,
                1024 - 1 - strlen('<' || lang || '> ') AS room
            FROM pairs
        ), texts AS (
            SELECT *, coalesce(array_to_string(list_filter(cl, lambda l, i: kept[i]), {NL}), '') AS clean FROM split
        ), long AS (SELECT * FROM texts WHERE strlen(raw) > room OR strlen(clean) > 767
        ), placed AS (
            SELECT doc_id, i, greatest(len(list_filter(kept[1:i], lambda k: k)), 1) AS unit, strlen(rl[i]) + 1 AS r,
                CASE WHEN kept[i] THEN strlen(cl[i]) + 1 ELSE 0 END AS c
            FROM (SELECT *, unnest(range(1, len(rl) + 1)) AS i FROM long WHERE list_contains(kept, true))
        ), units AS (
            SELECT doc_id, unit, sum(r) AS r, sum(c) AS c FROM placed GROUP BY doc_id, unit
        ), walk AS (
            SELECT doc_id, unit, 0 AS chunk_no, r, c FROM units WHERE unit = 1
            UNION ALL
            SELECT doc_id, u.unit, w.chunk_no + (w.r + u.r - 1 > room OR w.c + u.c - 1 > 767)::INT,
                u.r + CASE WHEN w.r + u.r - 1 > room OR w.c + u.c - 1 > 767 THEN 0 ELSE w.r END,
                u.c + CASE WHEN w.r + u.r - 1 > room OR w.c + u.c - 1 > 767 THEN 0 ELSE w.c END
            FROM walk w JOIN units u USING (doc_id) JOIN long USING (doc_id) WHERE u.unit = w.unit + 1
        ), joined AS (
            SELECT doc_id, chunk_no, any_value(room) AS room, string_agg(rl[i], {NL} ORDER BY i) AS raw,
                coalesce(string_agg(cl[i], {NL} ORDER BY i) FILTER (kept[i]), '') AS clean
            FROM walk JOIN placed USING (doc_id, unit) JOIN long USING (doc_id) GROUP BY doc_id, chunk_no)
        SELECT doc_id, chunk_no::BIGINT AS chunk_no,
            CASE WHEN strlen(raw) > room OR strlen(clean) > 767 THEN 'over_budget' ELSE 'ok' END AS status,
            md5(raw) AS raw_md5, md5(clean) AS clean_md5 FROM joined
        UNION ALL SELECT doc_id, 0, 'ok', md5(raw), md5(clean) FROM texts WHERE strlen(raw) <= room AND strlen(clean) <= 767
        UNION ALL SELECT doc_id, 0, 'unaligned', md5(raw), md5(clean) FROM long WHERE NOT list_contains(kept, true)""",
    "strip_text": f"""SELECT doc_id, md5(trim(' ' || chr(12288) || chr(10) || chr(28) || text || chr(8233) || chr(133)
        || chr(160), {SPACES})) AS stripped_md5 FROM documents""",
    "empty_passthrough": """SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN 'ok' ELSE 'empty' END AS status,
        md5(CASE WHEN lang = 'en' THEN trim(text) ELSE '' END) AS cleaned_md5 FROM documents""",
    "preview_text": """SELECT conv_id, turn,
        CASE WHEN length(text) > 110 THEN left(text, 110) || '...' ELSE text END AS raw_preview,
        CASE WHEN length(text) > 220 THEN left(text, 220) || '...' ELSE text END AS clean_preview,
        left(text, 200) AS head FROM conversations""",
    "argmax_ids": """SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1) || ','
        || (list_position(embedding, list_min(embedding)) - 1) AS predictions FROM embeddings""",
    "shard_names": f"WITH {LISTING} SELECT path, valid, idx, of_m FROM (SELECT path, valid,"
    " CASE WHEN valid THEN idx END AS idx, CASE WHEN valid THEN of_m END AS of_m FROM shards)",
    "shard_gaps": f"""WITH {LISTING}
        SELECT dataset, unnest(range(0, max(idx) + 1)) AS idx FROM shards WHERE valid GROUP BY dataset
        EXCEPT SELECT dataset, idx FROM shards WHERE valid""",
    "shard_duplicates": f"""WITH {LISTING} SELECT dataset, idx, count(*) AS n_files FROM shards WHERE valid
        GROUP BY dataset, idx HAVING count(*) > 1""",
    "shard_total_mismatch": f"""WITH {LISTING}, files AS (
            SELECT dataset, count(*) AS n_files FROM shards WHERE valid GROUP BY dataset)
        SELECT dataset, of_m, count(*) AS n_naming, n_files, of_m <> n_files AS mismatch
        FROM shards JOIN files USING (dataset) WHERE valid GROUP BY dataset, of_m, n_files""",
    "tmp_shards": f"WITH {LISTING} SELECT dataset, path FROM listing WHERE starts_with(name, 'tmp-')",
    "stray_files": f"""WITH {LISTING}, strays AS (
            SELECT * FROM listing WHERE top_level AND dataset NOT IN (SELECT dataset FROM train))
        SELECT dataset, name, n_files FROM (
            SELECT dataset, name, count(*) OVER (PARTITION BY dataset) AS n_files,
                row_number() OVER (PARTITION BY dataset ORDER BY name) AS r FROM strays) WHERE r <= 5""",
    "corrupt_shards": f"WITH {FOOTERS} SELECT dataset, path, error FROM footers WHERE error IS NOT NULL",
    "unknown_schema": f"WITH {FOOTERS} SELECT dataset, path, 'lang,text' AS cols FROM footers WHERE kind = 'unknown'",
    "mixed_schema": f"""WITH {FOOTERS}, k AS (
            SELECT dataset, count(*) FILTER (kind = 'tok') AS n_tok, count(*) FILTER (kind = 'raw') AS n_raw
            FROM footers WHERE kind <> 'unknown' GROUP BY dataset)
        SELECT *, n_tok > 0 AND n_raw > 0 AS mixed FROM k""",
    "shard_row_stats": f"""WITH {FOOTERS} SELECT dataset, count(*) AS n_files, sum(n_rows)::BIGINT AS total_rows,
        min(n_rows) AS min_rows, max(n_rows) AS max_rows FROM footers WHERE error IS NULL GROUP BY dataset""",
    "expected_rows": f"""WITH {FOOTERS}, k AS (
            SELECT dataset, min(kind) AS kind, sum(n_rows)::BIGINT AS total_rows FROM footers
            WHERE kind <> 'unknown' GROUP BY dataset HAVING count(DISTINCT kind) = 1)
        SELECT *, 1431369 - total_rows AS difference, CASE WHEN kind = 'tok' THEN 'info'
            WHEN total_rows <> 1431369 THEN 'warn' ELSE 'ok' END AS severity FROM k""",
    "sequence_stats": f"""WITH {PAIRS} SELECT min(strlen({TAGGED}) + 1)::BIGINT AS input_min,
        max(strlen({TAGGED}) + 1)::BIGINT AS input_max, min(strlen(clean) + 1)::BIGINT AS label_min,
        max(strlen(clean) + 1)::BIGINT AS label_max FROM pairs""",
    "empty_sequences": f"""WITH {LOSSY} SELECT count(*) FILTER (NOT regexp_matches(raw, '[0-9]')) AS input_empty,
        count(*) FILTER (NOT regexp_matches(clean, '[0-9]')) AS label_empty FROM lossy""",
    "audit_verdict": f"""WITH {FINDINGS}, ranked AS (
            SELECT *, CASE WHEN severity = 'fail' THEN row_number() OVER (
                PARTITION BY dataset, severity ORDER BY step, subject, ck) END AS r FROM findings)
        SELECT dataset, CASE WHEN count(*) FILTER (severity = 'fail') > 0 THEN 'fail' ELSE 'pass' END AS verdict,
            count(*) FILTER (severity = 'fail') AS n_fail, count(*) FILTER (severity = 'warn') AS n_warn,
            max(ck) FILTER (r = 1) AS first_failure FROM ranked GROUP BY dataset""",
    "audit_dataset": """SELECT 7::INT AS step, 'expected_rows' AS "check", 'warn' AS severity, 'shards' AS subject,
            count(*) AS n FROM documents HAVING count(*) <> 1431369
        UNION ALL SELECT 8, 'invalid_values', 'fail', 'lang_unsupported', count(*) FILTER (lang NOT IN ('id', 'en', 'zh'))
        FROM documents HAVING count(*) FILTER (lang NOT IN ('id', 'en', 'zh')) > 0""",
    "audit_report": f"""WITH {FINDINGS}, ranked AS (
            SELECT *, CASE WHEN severity = 'fail' THEN row_number() OVER (
                PARTITION BY dataset, severity ORDER BY step, subject, ck) END AS r FROM findings
        ), judged AS (
            SELECT dataset, count(*) FILTER (severity = 'fail') AS n_fail, count(*) FILTER (severity = 'warn') AS n_warn,
                max(ck) FILTER (r = 1) AS first_failure FROM ranked GROUP BY dataset
        ), stats AS (
            SELECT dataset, count(*) AS n_files, sum(n_rows)::BIGINT AS total_rows, min(n_rows) AS min_rows,
                max(n_rows) AS max_rows FROM footers WHERE error IS NULL GROUP BY dataset)
        SELECT dataset, CASE WHEN n_fail > 0 THEN 'fail' ELSE 'pass' END AS verdict, coalesce(n_fail, 0) AS n_fail,
            coalesce(n_warn, 0) AS n_warn, first_failure, coalesce(n_files, 0) AS n_files,
            coalesce(total_rows, 0)::BIGINT AS total_rows, min_rows, max_rows
        FROM (SELECT DISTINCT dataset FROM listing) LEFT JOIN judged USING (dataset) LEFT JOIN stats USING (dataset)""",
    "masked_token_accuracy": f"""WITH {PAIRS}, ids AS (
            SELECT {byte_ids('raw')} AS p, {byte_ids('clean')} AS y FROM pairs
        ), s AS (
            SELECT sum(list_sum(list_transform(list_zip(p[1:len(y)], y), lambda z: (z[1] = z[2])::INT)))::BIGINT AS n_hits,
                sum(len(y))::BIGINT AS n_counted FROM ids)
        SELECT n_hits, n_counted, 0::BIGINT AS mismatched, n_hits::DOUBLE / n_counted::DOUBLE AS token_accuracy FROM s""",
    "dataset_fingerprint": f"""WITH {PAIRS}, v AS (
            SELECT ('0x' || left(md5(md5(lang) || ':' || md5(raw) || ':' || md5(clean)), 15))::BIGINT AS v FROM pairs)
        SELECT count(*) AS n_rows, bit_xor(v) AS "xor", sum(v::HUGEINT)::VARCHAR AS total FROM v""",
    "split_counts": f"WITH {PAIRS}, {split_side('200')} SELECT split, count(*) AS n_rows FROM sided GROUP BY split",
    "train_val_split": f"WITH {PAIRS}, {split_side('n_val')} SELECT doc_id, split FROM sided",
    "val_cap": f"WITH {PAIRS}, {split_side('200')} SELECT doc_id, split FROM sided",
    "shuffle_limit": """SELECT doc_id, lang, md5(text) AS raw_md5 FROM documents
        ORDER BY md5('42:' || doc_id), doc_id LIMIT 150""",
    "length_groups": f"""WITH {BATCHED} SELECT doc_id, n_in::BIGINT AS length, mega_id::BIGINT AS mega_id,
        batch_id::BIGINT AS batch_id, pos::BIGINT AS pos FROM batched""",
    "batch_widths": f"""WITH {BATCHED} SELECT batch_id::BIGINT AS batch_id, n_rows, w_in::BIGINT AS input_width,
        w_lab::BIGINT AS label_width FROM widths""",
    "pad_inputs": f"""WITH {BATCHED} SELECT doc_id, batch_id::BIGINT AS batch_id, {digest('input_ids')} AS input_digest
        FROM padded""",
    "pad_labels": f"""WITH {BATCHED} SELECT doc_id, batch_id::BIGINT AS batch_id, {digest('label_ids')} AS label_digest
        FROM padded""",
    "attention_mask": f"""WITH {BATCHED} SELECT doc_id, batch_id::BIGINT AS batch_id, {digest('mask')} AS mask_digest
        FROM padded""",
    "collate": f"""WITH {BATCHED} SELECT batch_id::BIGINT AS batch_id, count(*) AS n_rows,
        {digest('flatten(list(input_ids ORDER BY pos))')} AS input_digest,
        {digest('flatten(list(mask ORDER BY pos))')} AS mask_digest,
        {digest('flatten(list(label_ids ORDER BY pos))')} AS label_digest FROM padded GROUP BY batch_id""",
    "padding_report": f"""WITH {BATCHED} SELECT batch_id::BIGINT AS batch_id, n_rows, s_in AS input_cells,
        (n_rows * w_in - s_in)::BIGINT AS input_padding, s_lab AS label_cells,
        (n_rows * w_lab - s_lab)::BIGINT AS label_padding FROM widths""",
    "clean_texts": f"""WITH {FURNISHED}, s AS (
            SELECT doc_id, lang, text, strlen('<' || lang || '> ' || text) + 1 AS n,
                CASE WHEN lang NOT IN ('en', 'id', 'de') THEN 'bad_lang' WHEN text = '' THEN 'empty'
                    WHEN strlen('<' || lang || '> ' || text) + 1 > 4096 THEN 'over_budget' ELSE 'ok' END AS status
            FROM furnished)
        SELECT doc_id, n::BIGINT AS n_tokens, status, md5(CASE WHEN status = 'empty' THEN '' WHEN status = 'ok' THEN
            trim({UNFURNISHED}, {SPACES}) END) AS cleaned_md5 FROM s""",
    "eval_cases": f"""WITH c AS (
            SELECT *, strlen('<' || lang || '> ' || text) >= 4096 AS over_budget,
                trim(CASE WHEN lang = 'en' THEN {keep_lines('text', '^the and ')} ELSE text END, {SPACES}) AS cleaned
            FROM documents)
        SELECT 'doc-' || doc_id AS name, lang, CASE WHEN over_budget THEN 'over_budget' ELSE 'ok' END AS status,
            CASE WHEN length(text) > 110 THEN left(text, 110) || '...' ELSE text END AS raw_preview,
            CASE WHEN over_budget THEN NULL WHEN length(cleaned) > 220 THEN left(cleaned, 220) || '...'
                ELSE cleaned END AS clean_preview,
            source AS expect FROM c""",
    "rule_bom": "SELECT doc_id, md5(text) AS cleaned_md5 FROM documents",
    "rule_mojibake": "SELECT doc_id, md5(regexp_replace(replace(text, '. ', '.' || chr(194) || chr(160)),"
    " '\\x{C2}\\x{A0}', ' ', 'g')) AS cleaned_md5 FROM documents",
    "rule_hex_artifact": "SELECT doc_id, md5(regexp_replace(replace(text, ', ', '0x00, '), '0x00', '', 'g')) AS cleaned_md5"
    " FROM documents",
    "rule_boilerplate": f"""WITH {FURNISHED} SELECT doc_id, md5({UNFURNISHED}) AS cleaned_md5 FROM furnished""",
    "no_duplication": f"""WITH {PAIRS}, both_sides AS (
            SELECT doc_id, unnest({lines('raw')}) AS line, 1 AS r, 0 AS c FROM pairs
            UNION ALL SELECT doc_id, unnest({lines('clean')}), 0, 1 FROM pairs
            UNION ALL SELECT doc_id, unnest(({lines('clean')})[1:2]), 0, 1 FROM pairs)
        SELECT doc_id, md5(line) AS line_md5, sum(r)::BIGINT AS n_raw, sum(c)::BIGINT AS n_clean FROM both_sides
        GROUP BY doc_id, line HAVING sum(c) > sum(r)""",
    "repeated_spans": f"""WITH {PAIRS}, words AS (
            SELECT doc_id, list_filter(string_split_regex(raw, '\\s+'), lambda w: w <> '') AS before,
                list_filter(string_split_regex(clean || ' ' || array_to_string((string_split_regex(clean, '\\s+'))[1:14], ' '), '\\s+'),
                    lambda w: w <> '') AS after
            FROM pairs
        ), known AS (
            SELECT doc_id, run, count(*) AS allowed FROM (
                SELECT doc_id, array_to_string(before[i:i + 7], ' ') AS run
                FROM (SELECT *, unnest(range(1, len(before) - 6)) AS i FROM words))
            GROUP BY doc_id, run
        ), runs AS (
            SELECT doc_id, i, array_to_string(after[i:i + 7], ' ') AS run
            FROM (SELECT *, unnest(range(1, len(after) - 6)) AS i FROM words)
        ), again AS (
            SELECT doc_id, i FROM (
                SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY i) AS k FROM runs) r
            LEFT JOIN known USING (doc_id, run) WHERE k > greatest(coalesce(allowed, 1), 1)
        ), islands AS (
            SELECT doc_id, min(i) AS a, max(i) AS b FROM (
                SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM again)
            GROUP BY doc_id, island)
        SELECT doc_id, a - 1 AS start, b - a + 8 AS n_words, md5(array_to_string(after[a:b + 7], ' ')) AS span_md5
        FROM islands JOIN words USING (doc_id)""",
    "number_loss": f"""WITH {LOSSY}, e AS ({item_excess(regex_all('raw', NUMBERS), regex_all('clean', NUMBERS), 'lossy')})
        SELECT doc_id, len({regex_all('raw', NUMBERS)})::BIGINT AS n_raw, coalesce(excess, 0)::BIGINT AS lost
        FROM lossy LEFT JOIN e USING (doc_id)""",
    "term_loss": f"""WITH {LOSSY}, {LEXICON}, w AS (
            SELECT doc_id, lang, unnest(regexp_extract_all(lower(raw), '[\\p{{L}}\\p{{N}}]+')) AS term, 1 AS a, 0 AS b
            FROM lossy WHERE lang <> 'es'
            UNION ALL SELECT doc_id, lang, unnest(regexp_extract_all(lower(clean), '[\\p{{L}}\\p{{N}}]+')), 0, 1
            FROM lossy WHERE lang <> 'es'
        ), t AS (
            SELECT doc_id, lang, kind, term, sum(a) AS r, sum(b) AS c FROM w JOIN lexicon USING (lang, term)
            GROUP BY doc_id, lang, kind, term
            UNION ALL SELECT doc_id, lang, kind, term,
                (length(raw) - length(replace(lower(raw), term, ''))) // length(term),
                (length(clean) - length(replace(lower(clean), term, ''))) // length(term)
            FROM lossy JOIN lexicon USING (lang) WHERE lang = 'es')
        SELECT doc_id, lang, kind, sum(r)::BIGINT AS n_raw, sum(c)::BIGINT AS n_clean,
            sum(greatest(r - c, 0))::BIGINT AS lost
        FROM t WHERE r > 0 OR c > 0 GROUP BY doc_id, lang, kind""",
    "structure_loss": f"""WITH {LOSSY}, {STRUCTURE} SELECT doc_id, items_raw, items_clean, rows_raw, rows_clean,
        greatest(items_raw - items_clean, 0) AS items_lost, greatest(rows_raw - rows_clean, 0) AS rows_lost FROM measured""",
    "ending_kept": f"WITH {LOSSY} SELECT doc_id, contains(clean, {LAST_LINE}) AS kept FROM lossy",
    "fidelity_summary": f"""WITH {LOSSY}, {STRUCTURE},
        num AS ({item_excess(regex_all('raw', NUMBERS), regex_all('clean', NUMBERS), 'lossy')}),
        dup AS ({item_excess(lines('clean'), lines('raw'), 'lossy')}),
        j AS (SELECT m.*, len({regex_all('raw', NUMBERS)}) AS nn, num.excess AS nl, dup.excess AS dl,
            contains(clean, {LAST_LINE}) AS kept
            FROM measured m LEFT JOIN num USING (doc_id) LEFT JOIN dup USING (doc_id))
        SELECT lang, grouping(lang) = 1 AS is_total, count(*) AS n_pairs, sum(nn)::BIGINT AS numbers,
            coalesce(sum(nl), 0)::BIGINT AS numbers_lost, sum(items_raw)::BIGINT AS items,
            sum(greatest(items_raw - items_clean, 0))::BIGINT AS items_lost, sum(rows_raw)::BIGINT AS table_rows,
            sum(greatest(rows_raw - rows_clean, 0))::BIGINT AS table_rows_lost,
            count(*) FILTER (kept) AS endings_kept, coalesce(sum(dl), 0)::BIGINT AS lines_duplicated
        FROM j GROUP BY ROLLUP (lang)""",
}

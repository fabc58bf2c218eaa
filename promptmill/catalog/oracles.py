"""The same results as plain SQL, written independently of the operators."""

from __future__ import annotations

# All input texts use these whitespace characters only.
BLANKS = "' ' || chr(9) || chr(10) || chr(13)"
EOS = "<|endoftext|>"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def stripped(expression: str) -> str:
    return f"trim({expression}, {BLANKS})"


USERS = """
users AS (
  SELECT conv_id, turn, text AS question, next_role, next_text,
         CASE WHEN next_role = 'assistant' THEN next_text END AS answer
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user')"""

PAIRS = USERS + """,
pairs AS (SELECT conv_id, turn, question, answer FROM users WHERE answer IS NOT NULL)"""

RAW_QA = USERS + """,
raw_qa AS (
  SELECT conv_id, turn,
    CASE conv_id % 7 WHEN 1 THEN ' ' || chr(10) || chr(9) || question || chr(10) || ' '
                     WHEN 2 THEN ' ' || chr(10) || ' ' ELSE question END AS question,
    CASE conv_id % 7 WHEN 3 THEN NULL
                     WHEN 4 THEN '  ' || answer || chr(10) || chr(10) ELSE answer END AS answer
  FROM users)"""


def labelled(source: str, limit: int) -> str:
    return f"""
labelled AS (
  SELECT *, CASE
      WHEN coalesce(length(question), 0) = 0 THEN 'missing_question'
      WHEN coalesce(length(answer), 0) = 0 THEN 'missing_answer'
      WHEN length(question) > {limit} THEN 'question_too_long'
      WHEN length(answer) > {limit} THEN 'answer_too_long' END AS reject_reason
  FROM (SELECT * REPLACE ({stripped('question')} AS question, {stripped('answer')} AS answer)
        FROM {source}))"""


# The system text, the heads of the templates and the departments.
SYSTEM_TEXT = (
    "\nRespond in the following format:\n<reasoning>\n...\n</reasoning>\n"
    "<answer>\n...\n</answer>\n"
)

PROMPTS = """
prompts AS (
  SELECT c_custkey AS prompt_id, 'What is the code of ' || c_name || '?' AS question,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_custkey % 4 AS VARCHAR) END AS gold
  FROM customer)"""

COMPLETIONS = """
completions AS (
  SELECT gen_id, prompt_id, status,
    CASE layout
      WHEN 0 THEN '<reasoning>' || n || thought || n || '</reasoning>' || n || '<answer>' || n
                  || a || n || '</answer>' || n
      WHEN 1 THEN '<reasoning>' || thought || '</reasoning> <answer>' || a || '</answer>'
      WHEN 2 THEN '<reasoning>' || n || thought || n || 'so it is' || n || '</reasoning>' || n
                  || '<answer>' || n || a || n || '</answer>' || n || 'That is all.'
      WHEN 3 THEN '  ' || a || ' ' || n
      WHEN 4 THEN '<reasoning>' || n || thought || n || '</reasoning>' || n || '<answer>' || n
                  || '9' || n || '</answer>' || n || '<answer>' || n || a || n || '</answer>' || n
      ELSE '<reasoning>' || n || thought || n || '</reasoning>' || n || '<answer>' || n
                  || a || n || '</answer>' END AS completion
  FROM (SELECT o_orderkey AS gen_id, o_custkey AS prompt_id, o_orderstatus AS status,
               'priority ' || o_orderpriority AS thought,
               CASE o_orderkey % 11 WHEN 0 THEN '-7' WHEN 1 THEN '7.0' WHEN 2 THEN 'seven'
                 WHEN 3 THEN '²' WHEN 4 THEN '' ELSE CAST(o_orderkey % 4 AS VARCHAR) END AS a,
               o_orderkey % 6 AS layout, chr(10) AS n
        FROM orders))"""

EXTRACTED = stripped(
    "string_split(list_extract(string_split(completion, '<answer>'), -1), '</answer>')[1]"
)


def times(needle: str) -> str:
    removed = f"length(completion) - length(replace(completion, {needle}, ''))"
    return f"(({removed}) = length({needle}))"


def tail(needle: str) -> str:
    return f"length(list_extract(string_split(completion, {needle}), -1))"


REASONING = "('<reasoning>' || chr(10))"
END_REASONING = "(chr(10) || '</reasoning>' || chr(10))"
ANSWER = "(chr(10) || '<answer>' || chr(10))"
END_ANSWER = "(chr(10) || '</answer>' || chr(10))"
SHORT_END = "(chr(10) || '</answer>')"
D125, D001, D0 = "CAST(0.125 AS DOUBLE)", "CAST(0.001 AS DOUBLE)", "CAST(0 AS DOUBLE)"

XML_COUNT = f"""
  ((({D0} + CASE WHEN {times(REASONING)} THEN {D125} ELSE {D0} END)
    + CASE WHEN {times(END_REASONING)} THEN {D125} ELSE {D0} END
    + CASE WHEN {times(ANSWER)} THEN {D125} ELSE {D0} END)
    - CASE WHEN {times(ANSWER)} THEN {tail(END_ANSWER)} * {D001} ELSE {D0} END
    + CASE WHEN {times(SHORT_END)} THEN {D125} ELSE {D0} END)
    - CASE WHEN {times(SHORT_END)} THEN ({tail(SHORT_END)} - 1) * {D001} ELSE {D0} END"""

STRICT = (
    r"regexp_matches(completion, '\A<reasoning>\n.*?\n</reasoning>\n<answer>\n.*?"
    r"\n</answer>\n\n?\z')"
)
SOFT = (
    r"regexp_matches(completion, '\A<reasoning>.*?</reasoning>\s*<answer>.*?</answer>')"
)


def points(condition: str, score: float) -> str:
    return f"CASE WHEN {condition} THEN CAST({score} AS DOUBLE) ELSE {D0} END"


SCORES = f"""
scores AS (
  SELECT gen_id, prompt_id, status, completion, extracted, gold,
         {XML_COUNT} AS reward_xml_count,
         {points(SOFT, 0.5)} AS reward_soft_format,
         {points(STRICT, 0.5)} AS reward_strict_format,
         {points("regexp_matches(extracted, '^[0-9²]+$')", 0.5)} AS reward_integer,
         {points("extracted = gold", 2.0)} AS reward_correctness
  FROM (SELECT c.*, {EXTRACTED} AS extracted, gold
        FROM completions c LEFT JOIN prompts USING (prompt_id))),
scored AS (
  SELECT *, reward_xml_count + reward_soft_format + reward_strict_format + reward_integer
            + reward_correctness AS reward_total
  FROM scores)"""

ALL_SCORES = f"WITH {PROMPTS}, {COMPLETIONS}, {SCORES}"
SCORE_COLUMNS = (
    "reward_xml_count, reward_soft_format, reward_strict_format, reward_integer, "
    "reward_correctness"
)

SOLUTIONS = """
solutions AS (
  SELECT o_orderkey, o_orderstatus AS subset, 'How urgent is ' || o_orderpriority || '?' AS asked,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 2 THEN ''
              ELSE CAST(o_orderkey % 100 AS VARCHAR) END AS answer
  FROM orders)"""

# Fixed value.
INSTRUCTION_HEAD = (
    "Below is an instruction that describes a task,\n"
    "paired with an input that provides further context.\n"
    "Write a response that appropriately completes the request.\n\n### Instruction:\n"
)


def instruction_text(instruction: str, given: str, response: str) -> str:
    parts = (
        quoted(INSTRUCTION_HEAD),
        instruction,
        quoted("\n\n### Input:\n"),
        given,
        quoted("\n\n### Response:\n"),
        response,
    )
    return " || ".join(parts)


CONVERSATION = "'conversation ' || CAST(conv_id AS VARCHAR)"
# Fixed value.
MEDICAL_HEAD = "你是一个专业的医疗助手。请根据患者的问题提供专业、准确的回答。\n\n### 问题：\n"
QA_TEXT = (
    f"{quoted(MEDICAL_HEAD)} || question || {quoted(chr(10) * 2 + '### 回答：' + chr(10))}"
    f" || answer || {quoted(EOS)}"
)

# Fixed values.
DEPARTMENTS = """
departments(number, dept_dir, department) AS (VALUES
  (0, 'IM_内科', '内科'), (1, 'Surgical_外科', '外科'), (2, 'Pediatric_儿科', '儿科'),
  (3, 'Oncology_肿瘤科', '肿瘤科'), (4, 'OAGD_妇产科', '妇产科'), (5, 'Andriatria_男科', '男科'))"""

MANIFEST = """
manifest AS (
  SELECT doc_id AS id, text AS prompt,
         CASE WHEN n_chars < 200 THEN '' WHEN n_chars >= 300
              THEN '/store/pictures/' || CAST(doc_id AS VARCHAR) || '.png' END AS image_path,
         CASE WHEN lang <> 'de' THEN source END AS response
  FROM documents)"""

TOKENS = r"""
words AS (
  SELECT doc_id, CASE WHEN body = '' THEN [] ELSE regexp_split_to_array(body, '[ \t\r\n]+') END
                 AS tokens
  FROM (SELECT doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS body FROM documents))"""

PLACED = TOKENS + """,
sized AS (SELECT doc_id, tokens, len(tokens) AS n_tokens FROM words WHERE len(tokens) > 0),
placed AS (
  SELECT *, CAST(sum(n_tokens) OVER (ORDER BY md5('3407:' || doc_id), doc_id) AS BIGINT)
            - n_tokens AS start
  FROM sized),
pieces AS (
  SELECT *, greatest(start, block_id * 2048) AS low,
            least(start + n_tokens, (block_id + 1) * 2048) AS high
  FROM (SELECT *, unnest(generate_series(start // 2048, (start + n_tokens - 1) // 2048))
                  AS block_id FROM placed)),
packed AS (
  SELECT doc_id, block_id, low - block_id * 2048 AS block_offset, low - start AS token_from,
         high - low AS token_count, tokens
  FROM pieces)"""


def spread(start: int, channel_order: str, channels: int) -> str:
    """Pixels of a 4x4 picture whose bytes repeat one digest."""
    byte = "substr(bytes, 2 * ((i * {n} + {c}) % 16) + 1, 2)"
    picks = " || ".join(byte.format(n=channels, c=c) for c in channel_order)
    return f"list_aggregate(list_transform(range(16), lambda i: {picks}), 'string_agg', '')"


PIXELS = (
    f"CASE doc_id % 3 WHEN 0 THEN {spread(0, '000', 1)} WHEN 1 THEN {spread(0, '210', 3)} "
    f"ELSE {spread(0, '210', 4)} END"
)
# Files hold red first.
FILE_PIXELS = PIXELS.replace(spread(0, "210", 3), spread(0, "012", 3)).replace(
    spread(0, "210", 4), spread(0, "012", 4)
)
PICTURES = """
pictures AS (SELECT doc_id, toxic, '/store/pictures/' || CAST(doc_id AS VARCHAR) || '.png' AS path,
                    md5(CAST(doc_id AS VARCHAR)) AS bytes FROM labels)"""


def schedule(table: str, epochs: str, micro: int, effective: int, limit: str = "") -> str:
    return f"""
WITH size AS (SELECT CAST(ceil(count(*) / {effective}.0) AS BIGINT) AS per_epoch FROM {table}),
ranked AS (
  SELECT doc_id, epoch, per_epoch, row_number() OVER (
           PARTITION BY epoch
           ORDER BY md5((3407 + epoch) || ':' || doc_id), doc_id) - 1 AS rank
  FROM {table}, size, (SELECT unnest(generate_series(0, {epochs})) AS epoch FROM size))
SELECT doc_id, CAST(epoch AS INTEGER) AS epoch, rank, epoch * per_epoch + rank // {effective} AS step,
       CAST((rank % {effective}) // {micro} AS INTEGER) AS micro_step
FROM ranked {limit}"""


ORACLES = {
    "format_instruction": f"""WITH {PAIRS} SELECT conv_id, turn,
        {instruction_text('question', CONVERSATION, 'answer')} || {quoted(EOS)} AS text
        FROM pairs""",
    "format_qa": f"WITH {PAIRS} SELECT conv_id, turn, {QA_TEXT} AS text FROM pairs",
    "format_custom": f"""WITH {PAIRS} SELECT conv_id, turn,
        'Q(' || {CONVERSATION} || '): ' || question || chr(10) || '{{json}} 100%s' || chr(10)
        || 'A: ' || answer || ' / ' || question AS text FROM pairs""",
    "format_null_cells": f"""WITH {USERS} SELECT conv_id, turn,
        {instruction_text('question', "'None'", "coalesce(answer, 'None')")} AS text FROM users""",
    "inference_prompt": f"""WITH {PAIRS} SELECT conv_id, turn,
        {instruction_text('question', CONVERSATION, "''")} AS prompt FROM pairs""",
    "select_text_field": f"WITH {PAIRS} SELECT {QA_TEXT} AS text FROM pairs",
    "response_text": f"""SELECT doc_id, CASE WHEN lang = 'en' THEN {stripped('text')}
        ELSE ' ' || text END AS response FROM documents""",
    "map_batched": f"""WITH {TOKENS} SELECT doc_id, upper(lang) AS lang,
        CAST(len(tokens) AS BIGINT) AS n_words FROM words JOIN documents USING (doc_id)""",
    "preview_first": """SELECT doc_id, substr(text, 1, 1000) AS preview
        FROM documents ORDER BY doc_id LIMIT 1""",
    "clean_qa": f"""WITH {RAW_QA}, {labelled('raw_qa', 1000)}
        SELECT '请回答以下医疗相关问题' AS instruction, question AS input, answer AS output,
               conv_id, turn FROM labelled WHERE reject_reason IS NULL""",
    "clean_qa_compatible": f"""WITH {RAW_QA},
        filled AS (SELECT conv_id, turn, coalesce(question, 'nan') AS question,
                          coalesce(answer, 'nan') AS answer FROM raw_qa),
        {labelled('filled', 1000)}
        SELECT '请回答以下医疗相关问题' AS instruction, question AS input, answer AS output,
               conv_id, turn FROM labelled WHERE reject_reason IS NULL""",
    "reject_reasons": f"""WITH {RAW_QA}, {labelled('raw_qa', 1000)}
        SELECT conv_id, turn, reject_reason FROM labelled""",
    "reject_report": f"""WITH {RAW_QA}, {labelled('raw_qa', 1000)}
        SELECT coalesce(reject_reason, 'kept') AS reason, count(*) AS n_rows
        FROM labelled GROUP BY 1""",
    "kept_count": f"""WITH {RAW_QA}, {labelled('raw_qa', 1000)}
        SELECT count(*) AS n_rows FROM labelled WHERE reject_reason IS NULL""",
    "observed_count": f"""WITH {RAW_QA}, {labelled('raw_qa', 1000)}
        SELECT count(*) AS n_rows FROM labelled WHERE reject_reason IS NULL""",
    "department_rejects": f"""WITH {RAW_QA}, {labelled('raw_qa', 1000)}, {DEPARTMENTS}
        SELECT dept_dir, coalesce(reject_reason, 'kept') AS reason, count(*) AS n_rows
        FROM labelled JOIN departments ON (conv_id + turn) % 6 = number GROUP BY ALL""",
    "reject_subtotals": f"""WITH {RAW_QA}, {labelled('raw_qa', 1000)}, {DEPARTMENTS},
        rows AS (SELECT dept_dir, dept_dir || '/part-' || CAST(conv_id % 3 AS VARCHAR) || '.csv' AS file,
                        coalesce(reject_reason, 'kept') AS reason
                 FROM labelled JOIN departments ON (conv_id + turn) % 6 = number)
        SELECT CASE WHEN grouping(dept_dir) = 1 THEN 'total' WHEN grouping(file) = 1 THEN 'dept_dir'
                    WHEN grouping(reason) = 1 THEN 'file' ELSE 'reason' END AS level,
               dept_dir, file, reason, count(*) AS n_rows
        FROM rows GROUP BY ROLLUP (dept_dir, file, reason)""",
    "alias_columns": f"""WITH {USERS} SELECT conv_id, turn,
        CASE WHEN conv_id % 4 < 3 THEN question END AS question_raw,
        CASE conv_id % 4 WHEN 2 THEN CAST(conv_id AS VARCHAR) WHEN 3 THEN NULL ELSE answer END
          AS answer_raw,
        conv_id % 4 < 3 AS answer_known FROM users""",
    "extra_columns": """SELECT doc_id,
        CASE WHEN doc_id % 3 = 0 THEN lang END AS lang,
        CASE WHEN doc_id % 3 = 1 THEN source END AS source,
        CASE WHEN doc_id % 3 = 1 THEN n_chars END AS n_chars
        FROM documents WHERE doc_id IS NOT NULL""",
    "union_sources": """
        SELECT 'documents' AS origin, doc_id AS id, text, lang FROM documents
        UNION ALL SELECT 'benchmark', item_id, text, NULL FROM benchmark
        UNION ALL SELECT 'pages', page_id, html, NULL FROM pages""",
    "department_names": f"""WITH {DEPARTMENTS} SELECT doc_id, dept_dir, department
        FROM documents JOIN departments ON CAST(substr(source, 4) AS INTEGER) % 6 = number""",
    "table_profile": """SELECT 'page_id, url, html' AS columns, count(*) AS n_rows,
        3 AS n_columns FROM pages""",
    "column_profile": """SELECT 'doc_id' AS column, count(*) AS n_rows, count(*) - count(doc_id) AS n_null,
               count(*) FILTER (WHERE CAST(doc_id AS VARCHAR) = '') AS n_empty, CAST(min(length(CAST(doc_id AS VARCHAR))) AS BIGINT) AS min_length,
               CAST(max(length(CAST(doc_id AS VARCHAR))) AS BIGINT) AS max_length, CAST(coalesce(sum(length(CAST(doc_id AS VARCHAR))), 0) AS BIGINT) AS sum_length FROM documents
        UNION ALL SELECT 'text' AS column, count(*) AS n_rows, count(*) - count(text) AS n_null,
               count(*) FILTER (WHERE CAST(text AS VARCHAR) = '') AS n_empty, CAST(min(length(CAST(text AS VARCHAR))) AS BIGINT) AS min_length,
               CAST(max(length(CAST(text AS VARCHAR))) AS BIGINT) AS max_length, CAST(coalesce(sum(length(CAST(text AS VARCHAR))), 0) AS BIGINT) AS sum_length FROM documents
        UNION ALL SELECT 'lang' AS column, count(*) AS n_rows, count(*) - count(lang) AS n_null,
               count(*) FILTER (WHERE CAST(lang AS VARCHAR) = '') AS n_empty, CAST(min(length(CAST(lang AS VARCHAR))) AS BIGINT) AS min_length,
               CAST(max(length(CAST(lang AS VARCHAR))) AS BIGINT) AS max_length, CAST(coalesce(sum(length(CAST(lang AS VARCHAR))), 0) AS BIGINT) AS sum_length FROM documents
        UNION ALL SELECT 'source' AS column, count(*) AS n_rows, count(*) - count(source) AS n_null,
               count(*) FILTER (WHERE CAST(source AS VARCHAR) = '') AS n_empty, CAST(min(length(CAST(source AS VARCHAR))) AS BIGINT) AS min_length,
               CAST(max(length(CAST(source AS VARCHAR))) AS BIGINT) AS max_length, CAST(coalesce(sum(length(CAST(source AS VARCHAR))), 0) AS BIGINT) AS sum_length FROM documents
        UNION ALL SELECT 'n_chars' AS column, count(*) AS n_rows, count(*) - count(n_chars) AS n_null,
               count(*) FILTER (WHERE CAST(n_chars AS VARCHAR) = '') AS n_empty, CAST(min(length(CAST(n_chars AS VARCHAR))) AS BIGINT) AS min_length,
               CAST(max(length(CAST(n_chars AS VARCHAR))) AS BIGINT) AS max_length, CAST(coalesce(sum(length(CAST(n_chars AS VARCHAR))), 0) AS BIGINT) AS sum_length FROM documents""",
    "record_rejects": """SELECT format, doc_id,
        CASE WHEN doc_id % 50 = 0 THEN 'malformed_record' ELSE 'kept' END AS status
        FROM documents, (VALUES ('json'), ('csv')) AS formats(format)""",
    "hash_answer": f"WITH {SOLUTIONS} SELECT o_orderkey, answer FROM solutions",
    "xml_answer": f"""WITH {COMPLETIONS}
        SELECT gen_id, {EXTRACTED} AS extracted FROM completions""",
    "xml_cot": f"""WITH {PAIRS} SELECT conv_id, turn, '<reasoning>' || chr(10) || question
        || chr(10) || '</reasoning>' || chr(10) || '<answer>' || chr(10) || answer || chr(10)
        || '</answer>' || chr(10) AS text FROM pairs""",
    "chat_prompt": f"""WITH {PROMPTS} SELECT prompt_id, 'system' AS first_role,
        {quoted(SYSTEM_TEXT)} AS system_text, 'user' AS last_role, question AS question_text,
        gold AS answer FROM prompts""",
    "chat_text": f"""SELECT doc_id, '<|im_start|>system' || chr(10) || {quoted(SYSTEM_TEXT)}
        || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || text || '<|im_end|>'
        || chr(10) || '<|im_start|>assistant' || chr(10) AS chat FROM documents""",
    "chat_exchange": f"""WITH {PAIRS} SELECT conv_id, turn, '<|im_start|>user' || chr(10)
        || question || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || answer
        || '<|im_end|>' || chr(10) AS chat FROM pairs""",
    "attach_gold": f"""WITH {PROMPTS}, {COMPLETIONS} SELECT gen_id, prompt_id, gold
        FROM completions LEFT JOIN prompts USING (prompt_id)""",
    "reward_correctness": f"{ALL_SCORES} SELECT gen_id, reward_correctness FROM scored",
    "reward_integer": f"{ALL_SCORES} SELECT gen_id, reward_integer FROM scored",
    "reward_strict_format": f"{ALL_SCORES} SELECT gen_id, reward_strict_format FROM scored",
    "reward_soft_format": f"{ALL_SCORES} SELECT gen_id, reward_soft_format FROM scored",
    "reward_xml_count": f"{ALL_SCORES} SELECT gen_id, reward_xml_count FROM scored",
    "reward_total": f"{ALL_SCORES} SELECT gen_id, {SCORE_COLUMNS}, reward_total FROM scored",
    "reward_weighted": f"""{ALL_SCORES} SELECT gen_id, reward_xml_count + reward_soft_format
        + reward_strict_format + reward_integer * CAST(2 AS DOUBLE)
        + reward_correctness * CAST(0.5 AS DOUBLE) AS reward_total FROM scored""",
    "reward_python": f"""{ALL_SCORES} SELECT gen_id, brevity AS reward_brevity,
        reward_total + brevity AS reward_total
        FROM (SELECT *, {points("length(completion) < 40 AND status <> 'P'", 0.25)} AS brevity
              FROM scored)""",
    "reward_means": f"""{ALL_SCORES}, long AS (UNPIVOT (SELECT status, {SCORE_COLUMNS}, reward_total
          FROM scored) ON {SCORE_COLUMNS}, reward_total INTO NAME reward_name VALUE reward)
        SELECT status, reward_name, round(avg(reward), 9) + 0.0 AS mean_reward
        FROM long GROUP BY status, reward_name""",
    "group_stats": f"""{ALL_SCORES} SELECT prompt_id, count(*) AS n,
        round(avg(reward_total), 9) + 0.0 AS mean_reward,
        round(stddev_samp(reward_total), 9) + 0.0 AS std_reward,
        round(max(reward_total), 9) + 0.0 AS max_reward FROM scored GROUP BY prompt_id""",
    "advantages": f"""{ALL_SCORES} SELECT gen_id, prompt_id,
        round(CASE WHEN n = 1 OR low = high THEN 0.0
              ELSE (reward_total - mean) / (std + CAST(0.0001 AS DOUBLE)) END, 6) + 0.0 AS advantage
        FROM (SELECT *, count(*) OVER g AS n, avg(reward_total) OVER g AS mean,
                     stddev_samp(reward_total) OVER g AS std, min(reward_total) OVER g AS low,
                     max(reward_total) OVER g AS high
              FROM scored WINDOW g AS (PARTITION BY prompt_id))""",
    "stream_advantages": f"""{ALL_SCORES} SELECT gen_id, prompt_id,
        round(CASE WHEN n = 1 OR low = high THEN 0.0
              ELSE (reward_total - mean) / (std + CAST(0.0001 AS DOUBLE)) END, 6) + 0.0 AS advantage
        FROM (SELECT *, count(*) OVER g AS n, avg(reward_total) OVER g AS mean,
                     stddev_samp(reward_total) OVER g AS std, min(reward_total) OVER g AS low,
                     max(reward_total) OVER g AS high
              FROM scored WINDOW g AS (PARTITION BY prompt_id))""",
    "reward_messages": f"{ALL_SCORES} SELECT gen_id, {SCORE_COLUMNS}, reward_total FROM scored",
    "best_of_n": f"""{ALL_SCORES} SELECT prompt_id, gen_id, completion, reward_total
        FROM (SELECT *, row_number() OVER (PARTITION BY prompt_id ORDER BY reward_total DESC, gen_id)
              AS place FROM scored) WHERE place = 1""",
    "shuffle_order": """SELECT doc_id, source,
        row_number() OVER (ORDER BY md5('3407:' || doc_id), doc_id) - 1 AS rank FROM documents""",
    "shuffle_sorted": """SELECT doc_id, lang,
        row_number() OVER (ORDER BY md5('3407:' || doc_id), doc_id) - 1 AS place FROM documents""",
    "sample_budget": """SELECT doc_id, n_chars, rank FROM (SELECT doc_id, n_chars,
        row_number() OVER (ORDER BY md5('3407:' || doc_id), doc_id) - 1 AS rank FROM documents)
        WHERE rank < 480""",
    "schedule_epochs": schedule("documents", "2", 4, 16),
    "schedule_resume": schedule("documents", "2", 4, 16, "WHERE epoch * per_epoch + rank // 16 >= 20"),
    "schedule_steps": schedule(
        "labels", "(240 - 1) // per_epoch", 2, 8,
        "WHERE epoch * per_epoch + rank // 8 < 240",
    ),
    "token_limit": f"""WITH {TOKENS} SELECT doc_id, CAST(len(tokens) AS BIGINT) AS n_tokens,
        CAST(least(len(tokens), 512) AS BIGINT) AS n_kept,
        array_to_string(tokens[1:512], ' ') AS kept_text FROM words""",
    "prompt_limit": f"""WITH {PAIRS}, sizes AS (SELECT conv_id, turn,
          CAST(len(regexp_split_to_array({stripped('question')}, '\\s+')) AS BIGINT) AS p,
          CAST(len(regexp_split_to_array({stripped('answer')}, '\\s+')) AS BIGINT) AS c
          FROM pairs)
        SELECT conv_id, turn, p AS prompt_tokens, c AS completion_tokens,
               p <= 64 AND c <= 192 AS fits FROM sizes""",
    "pack_blocks": f"""WITH {PLACED} SELECT doc_id, block_id, block_offset, token_from,
        token_count FROM packed""",
    "packed_text": f"""WITH {PLACED} SELECT block_id, CAST(sum(token_count) AS BIGINT) AS n_tokens,
        string_agg(array_to_string(tokens[token_from + 1:token_from + token_count], ' '), ' '
                   ORDER BY block_offset) AS block_text FROM packed GROUP BY block_id""",
    "vision_records": f"""WITH {MANIFEST} SELECT id, 'user' AS user_role,
        'text,image' AS user_types, prompt AS user_text, image_path AS image_origin,
        'assistant' AS reply_role, response AS reply_text FROM manifest
        WHERE image_path <> '' AND response IS NOT NULL AND id IN (SELECT doc_id FROM labels)""",
    "vision_pixels": f"""WITH {MANIFEST}, {PICTURES} SELECT id, image_path AS origin,
        CAST(3 AS BIGINT) AS n_channels, {PIXELS} AS pixels
        FROM manifest JOIN pictures ON image_path = path
        WHERE response IS NOT NULL AND toxic = 0""",
    "to_rgb": f"WITH {PICTURES} SELECT doc_id, {PIXELS} AS pixels FROM pictures WHERE toxic = 0",
    "vision_inference": """SELECT doc_id, '<|im_start|>user' || chr(10) || '<image>' || text
        || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS chat
        FROM documents""",
    "image_exists": f"""WITH {MANIFEST} SELECT id, image_path FROM manifest
        WHERE image_path <> '' AND id IN (SELECT doc_id FROM labels)""",
    "image_missing": f"""WITH {MANIFEST} SELECT id, image_path FROM manifest
        WHERE image_path <> '' AND id NOT IN (SELECT doc_id FROM labels)""",
    "vision_rejects": f"""WITH {MANIFEST} SELECT id, CASE
          WHEN coalesce(image_path, '') = '' THEN 'empty_image_path'
          WHEN toxic IS NULL THEN 'image_not_found'
          WHEN response IS NULL THEN 'missing_prompt_or_response'
          WHEN toxic = 1 THEN 'undecodable_image' END AS reject_reason
        FROM manifest LEFT JOIN labels ON id = doc_id""",
    "vision_files": f"""WITH {PICTURES} SELECT d.doc_id AS id, 'say "' || lang || '", please' AS user_text,
        source AS reply_text, pixels
        FROM documents d JOIN (SELECT doc_id, toxic, {FILE_PIXELS} AS pixels FROM pictures) USING (doc_id)
        WHERE n_chars >= 300 AND lang <> 'de' AND toxic = 0""",
    "vision_file_rejects": """SELECT d.doc_id AS id, CASE
          WHEN n_chars < 300 THEN 'empty_image_path'
          WHEN toxic IS NULL THEN 'image_not_found'
          WHEN lang = 'de' THEN 'missing_prompt_or_response'
          WHEN toxic = 1 THEN 'undecodable_image' END AS reject_reason
        FROM documents d LEFT JOIN labels USING (doc_id)""",
    "image_stores": """SELECT id, 's3a://' || bucket || '/pictures/' || id || '.png' AS image_path,
        CASE WHEN id NOT IN (SELECT doc_id FROM labels) OR (bucket = 'b' AND id % 3 <> 0)
             THEN 'image_not_found' END AS reject_reason
        FROM (SELECT doc_id AS id, CASE doc_id % 2 WHEN 0 THEN 'a' ELSE 'b' END AS bucket FROM documents)""",
    "decode_csv": f"""WITH {USERS}, said AS (SELECT * REPLACE (
            CASE (conv_id + turn) % 6 WHEN 2 THEN regexp_replace(question, '[^\x00-\x7F]', '字', 'g')
              ELSE question END AS question,
            CASE (conv_id + turn) % 6 WHEN 2 THEN regexp_replace(answer, '[^\x00-\x7F]', '字', 'g')
              ELSE answer END AS answer) FROM users),
        {labelled('said', 1000)}, {DEPARTMENTS}
        SELECT department, CASE number WHEN 2 THEN 'gbk' WHEN 3 THEN 'gb18030' ELSE 'utf-8' END AS encoding,
               question, coalesce(answer, '') AS answer, reject_reason
        FROM labelled JOIN departments ON (conv_id + turn) % 6 = number WHERE number < 4""",
    "file_rejects": f"""WITH {USERS}, {DEPARTMENTS},
        written AS (SELECT DISTINCT dept_dir, number FROM users
                    JOIN departments ON (conv_id + turn) % 6 = number WHERE number < 5)
        SELECT dept_dir, 'part' AS name,
               CASE number WHEN 2 THEN 'gbk' WHEN 3 THEN 'gb18030' WHEN 4 THEN NULL ELSE 'utf-8' END AS encoding,
               CASE number WHEN 4 THEN 'undecodable_file' END AS reject_reason FROM written
        UNION ALL SELECT dept_dir, unnest(['_left.csv', '.out.csv', 'none.csv']), NULL,
               unnest(['hidden_name', 'hidden_name', 'empty_file']) FROM departments WHERE number = 0
        UNION ALL SELECT dept_dir, NULL, NULL, 'missing_folder' FROM departments WHERE number = 5""",
    "training_set_files": f"""SELECT source AS instruction, CAST(doc_id AS VARCHAR) AS input,
        text AS output, lang AS split FROM documents""",
    "prompt_set_files": f"WITH {SOLUTIONS} SELECT o_orderkey, subset, asked, answer FROM solutions",
    "vision_set_files": f"""WITH {MANIFEST} SELECT id, prompt AS user_text,
        image_path AS image_origin FROM manifest
        WHERE image_path <> '' AND response IS NOT NULL AND id IN (SELECT doc_id FROM labels)""",
    "reject_files": f"""WITH {RAW_QA}, {labelled('raw_qa', 1000)}
        SELECT conv_id, turn, reject_reason FROM labelled WHERE reject_reason IS NOT NULL""",
    "stream_format": f"""SELECT doc_id, {instruction_text('source', 'lang', 'text')} AS text
        FROM documents""",
    "format_twice": f"""SELECT doc_id, {instruction_text('source', 'lang', 'text')} AS text
        FROM documents""",
    "stream_score": f"{ALL_SCORES} SELECT gen_id, {SCORE_COLUMNS}, reward_total FROM scored",
    "missing_cells": """SELECT o_orderkey, (price IS NULL OR isnan(price)) AS price_missing, comment IS NULL AS comment_missing
        FROM (SELECT o_orderkey,
                     CASE WHEN o_orderkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) WHEN o_orderkey % 11 = 0 THEN NULL
                          ELSE CAST(o_totalprice AS DOUBLE) END AS price,
                     CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS comment FROM orders)""",
    "stream_reward_windows": f"""{ALL_SCORES}, long AS (UNPIVOT (SELECT (CAST(gen_id AS BIGINT) // 32 // 10) * 10 AS logging_step,
          {SCORE_COLUMNS}, reward_total FROM scored) ON {SCORE_COLUMNS}, reward_total INTO NAME reward_name VALUE reward)
        SELECT CAST(logging_step AS BIGINT) AS logging_step, reward_name, round(avg(reward), 9) + 0.0 AS mean_reward
        FROM long GROUP BY logging_step, reward_name""",
    "stream_samples": f"""WITH {RAW_QA}, {labelled('raw_qa', 1000)}
        SELECT '请回答以下医疗相关问题' AS instruction, question AS input, answer AS output,
               conv_id, turn FROM labelled WHERE reject_reason IS NULL""",
    "stream_rejects": f"""WITH {RAW_QA}, {labelled('raw_qa', 1000)}
        SELECT conv_id, turn, reject_reason FROM labelled WHERE reject_reason IS NOT NULL""",
}

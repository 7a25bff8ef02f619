"""DuckDB SQL for the registered queries, over views of the given tables.

Written from the definitions, not from the Spark plans: conversations are
joined with themselves, texts are aggregated and cut, groups are ranked.
"""

from __future__ import annotations

from colloquy.functions.fixed import (
    ADDED_TOKENS,
    DEFAULT_SYSTEM_PROMPT,
    SAMPLING_PRESETS,
    SPECIAL_TOKENS,
    SWEEP,
    TASK_INSTRUCTIONS,
    TOOLS_INTRO,
    TOOLS_OUTRO,
    WHITESPACE,
)

NL = "chr(10)"


def text(value: str) -> str:
    """An SQL literal for any text."""
    parts = [f"'{p}'" for p in value.replace("'", "''").split("\n")]
    return "(" + " || chr(10) || ".join(parts) + ")"


def chars(value: str) -> str:
    return "(" + " || ".join(f"chr({ord(c)})" for c in value) + ")"


BLANKS = chars(WHITESPACE)


#: 16-bit numbers from which a Poisson(1) draw is at least 1, 2, ...
POISSON = (24110, 48219, 60274, 64292, 65297, 65498, 65531, 65536)


def unit(tag: str, *keys: str) -> str:
    key = " || '|' || ".join([f"'{tag}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"((('0x' || substring(md5({key}), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"


TURNS = "turns AS (SELECT conv_id, turn, role, text AS content FROM conversations)"

THINKS = "(role = 'assistant' AND turn % 4 IN (1, 2))"
CALLS = f"({THINKS} AND conv_id % 5 = 0)"
MARKED = f"""
marked AS (
  SELECT conv_id, turn * 10 AS turn, role,
    CASE
      WHEN role = 'assistant' AND conv_id % 11 = 5 AND turn >= 3 THEN NULL
      WHEN {THINKS} THEN '<think>' || {NL} || 'plan ' || turn || {NL} || '</think>' || {NL} || {NL} || text
      WHEN role = 'assistant' AND conv_id % 4 = 0 THEN 'a<think>x</think>mid</think>' || {NL} || text
      WHEN role = 'user' AND turn >= 2 AND conv_id % 7 = 3
        THEN '<tool_response>' || {NL} || text || {NL} || '</tool_response>'
      WHEN role = 'user' AND turn >= 2 AND conv_id % 3 = 1 THEN text || ' /no_think'
      WHEN role = 'user' AND conv_id % 3 = 2 THEN text || ' /think'
      ELSE text END AS content,
    CASE WHEN role = 'assistant' AND conv_id % 13 = 6 THEN 'kept apart ' || turn END AS aside,
    CASE WHEN {CALLS} THEN CASE WHEN conv_id % 10 = 0 THEN 2 ELSE 1 END ELSE 0 END AS calls
  FROM conversations
  UNION ALL SELECT conv_id, turn * 10 + 1, 'tool', 'result one', NULL, 0 FROM conversations WHERE {CALLS}
  UNION ALL SELECT conv_id, turn * 10 + 2, 'tool', 'result two', NULL, 0 FROM conversations WHERE {CALLS}
  UNION ALL SELECT conv_id, turn * 10 + 3, 'assistant',
    '<think>' || {NL} || 'use it' || {NL} || '</think>' || {NL} || {NL} || 'done', NULL, 0
  FROM conversations WHERE {CALLS}
  UNION ALL SELECT conv_id, turn * 10 + 4, 'note', 'aside', NULL, 0
  FROM conversations WHERE role = 'user' AND conv_id % 9 = 4
  UNION ALL SELECT conv_id, turn * 10 + 5, 'system', 'be brief /no_think', NULL, 0
  FROM conversations WHERE role = 'user' AND turn = 1 AND conv_id % 8 = 3
)"""

HAS_TOOLS = "conv_id % 6 = 1"

# Positions, neighbours, and the two texts of an assistant turn.
PLACED = f"""
placed AS (
  SELECT *, row_number() OVER w - 1 AS i, lag(role) OVER w AS prev_role, lead(role) OVER w AS next_role,
    coalesce(content, '') AS body,
    role = 'user' AND content IS NOT NULL
      AND NOT (starts_with(content, '<tool_response>') AND ends_with(content, '</tool_response>')) AS query,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM marked WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
),
parted AS (
  SELECT *,
    CASE WHEN aside IS NOT NULL THEN aside
      WHEN contains(body, '</think>')
      THEN ltrim(split_part(rtrim(split_part(body, '</think>', 1), {NL}), '<think>', -1), {NL})
      ELSE '' END AS reasoning,
    CASE WHEN aside IS NULL AND contains(body, '</think>')
      THEN ltrim(split_part(body, '</think>', -1), {NL}) ELSE body END AS answer
  FROM placed
),
called AS (
  SELECT *,
    CASE WHEN calls = 0 THEN '' ELSE
      CASE WHEN answer <> '' THEN {NL} ELSE '' END
      || '<tool_call>' || {NL} || '{{"name": "lookup", "arguments": {{"k": ' || conv_id || '}}}}' || {NL} || '</tool_call>'
      || CASE WHEN calls = 2 THEN
        {NL} || '<tool_call>' || {NL} || '{{"name": "again", "arguments": {{"k": ' || conv_id || '}}}}' || {NL} || '</tool_call>'
        ELSE '' END
    END AS call_text
  FROM parted
),
forms AS (
  SELECT *,
    CASE WHEN i = 0 AND {HAS_TOOLS} THEN
      '<|im_start|>system' || {NL} || CASE WHEN role = 'system' THEN body || {NL} || {NL} ELSE '' END
      || {text(TOOLS_INTRO)} || {NL} || '{{"name": "lookup"}}' || {NL} || '{{"name": "again"}}'
      || {text(TOOLS_OUTRO)} || '<|im_end|>' || {NL}
      ELSE '' END AS head,
    CASE
      WHEN role = 'user' OR (role = 'system' AND NOT (i = 0 AND {HAS_TOOLS}))
        THEN '<|im_start|>' || role || {NL} || body || '<|im_end|>' || {NL}
      WHEN role = 'assistant'
        THEN '<|im_start|>assistant' || {NL} || answer || call_text || '<|im_end|>' || {NL}
      WHEN role = 'tool' THEN
        CASE WHEN coalesce(prev_role, '') <> 'tool' THEN '<|im_start|>user' ELSE '' END
        || {NL} || '<tool_response>' || {NL} || body || {NL} || '</tool_response>'
        || CASE WHEN coalesce(next_role, '') <> 'tool' THEN '<|im_end|>' || {NL} ELSE '' END
      ELSE '' END AS short,
    CASE WHEN role = 'assistant' THEN
      '<|im_start|>assistant' || {NL} || '<think>' || {NL} || trim(reasoning, {NL}) || {NL} || '</think>'
      || {NL} || {NL} || ltrim(answer, {NL}) || call_text || '<|im_end|>' || {NL} END AS long
  FROM called
),
asked AS (
  SELECT conv_id, coalesce(max(i) FILTER (WHERE query), max(i)) AS last_query_index FROM placed GROUP BY conv_id
)"""

SEGMENTS = f"""
segments AS (
  SELECT f.conv_id, f.turn, f.i, f.role, f.n,
    f.head || CASE WHEN f.role = 'assistant' AND f.i > a.last_query_index AND (f.i = f.n - 1 OR f.reasoning <> '')
      THEN f.long ELSE f.short END AS segment
  FROM forms f JOIN asked a USING (conv_id)
)"""

RENDERED = """
rendered AS (
  SELECT conv_id, string_agg(segment, '' ORDER BY i) AS prompt FROM segments GROUP BY conv_id
)"""

CHAT = f"WITH {MARKED}, {PLACED}, {SEGMENTS}, {RENDERED}"
GENERATION = f"'<|im_start|>assistant' || {NL}"

EXITS = f"""
exits AS (
  SELECT conv_id, turn, role, CASE
    WHEN role = 'user' AND turn = 4 AND conv_id % 4 = 1 THEN '  QUIT' || chr(12288)
    WHEN role = 'user' AND turn = 2 AND conv_id % 4 = 2 THEN '退出'
    WHEN role = 'user' AND turn = 2 AND conv_id % 4 = 3 THEN ' ' || chr(9) || chr(160) || chr(10)
    ELSE text END AS content
  FROM conversations
)"""

PAIRS = f"""
{TURNS},
followed AS (
  SELECT *, lead(role) OVER w AS next_role, lead(content) OVER w AS next_content
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
),
qa AS (
  SELECT conv_id, turn, content AS prompt, next_content AS answer
  FROM followed WHERE role = 'user' AND next_role = 'assistant'
),
judged AS (
  SELECT conv_id, turn, prompt, answer AS chosen,
    lead(answer) OVER (PARTITION BY turn ORDER BY conv_id) AS rejected
  FROM qa
)"""

LOGPS = f"""
{PAIRS},
logps AS (
  SELECT conv_id, turn,
    CASE WHEN conv_id % 17 = 3 THEN 0 ELSE -length(chosen) * (0.5 + {unit("pi_c", "conv_id", "turn")}) END AS pi_chosen,
    -length(chosen) * (0.5 + {unit("ref_c", "conv_id", "turn")}) AS ref_chosen,
    CASE WHEN conv_id % 17 = 3 AND conv_id % 2 = 0 THEN 0
      ELSE -length(rejected) * (0.5 + {unit("pi_r", "conv_id", "turn")}) END AS pi_rejected,
    -length(rejected) * (0.5 + {unit("ref_r", "conv_id", "turn")}) AS ref_rejected,
    CASE WHEN conv_id % 19 = 5 THEN 0 ELSE length(chosen) END AS len_chosen, length(rejected) AS len_rejected
  FROM judged WHERE rejected IS NOT NULL
)"""


def loss(margin: str) -> str:
    return f"(greatest(-({margin}), 0) + ln(1 + exp(-abs({margin}))))"


DPO = f"""
{LOGPS},
margins AS (
  SELECT conv_id, turn, 0.1::DOUBLE * ((pi_chosen - ref_chosen) - (pi_rejected - ref_rejected)) AS margin FROM logps
),
scored AS (SELECT conv_id, turn, margin, {loss("margin")} AS loss, margin > 0 AS correct FROM margins)"""

# Odds of a certain side are infinite: the loss is 0 if that is the chosen one; without a ratio it is null.
ORPO = f"""
{LOGPS},
means AS (
  SELECT conv_id, turn, CASE WHEN len_chosen > 0 THEN pi_chosen / len_chosen END AS c,
    CASE WHEN len_rejected > 0 THEN pi_rejected / len_rejected END AS r FROM logps
),
odds AS (
  SELECT conv_id, turn, c = 0 AS sure_c, r = 0 AS sure_r, CASE WHEN c < 0 THEN c - ln(1 - exp(c)) END AS c,
    CASE WHEN r < 0 THEN r - ln(1 - exp(r)) END AS r FROM means
),
ratios AS (
  SELECT conv_id, turn, CASE WHEN sure_c AND r IS NOT NULL THEN 'infinity'::DOUBLE
    WHEN sure_r AND c IS NOT NULL THEN '-infinity'::DOUBLE ELSE c - r END AS log_odds_ratio FROM odds
),
scored AS (
  SELECT conv_id, turn, log_odds_ratio, CASE WHEN isinf(log_odds_ratio) THEN greatest(-log_odds_ratio, 0)
    ELSE {loss("log_odds_ratio")} END AS loss, log_odds_ratio > 0 AS correct FROM ratios
)"""

REWARDS = f"""
rewards AS (
  SELECT d.source, l.quality, 4 * {unit("reward", "d.doc_id")} - 2 AS reward,
    row_number() OVER (PARTITION BY d.source, l.quality ORDER BY d.doc_id) - 1 AS pair
  FROM documents d JOIN labels l USING (doc_id)
),
scored AS (
  SELECT c.reward AS chosen, r.reward AS rejected,
    {loss("c.reward - r.reward")} AS loss, c.reward > r.reward AS correct
  FROM (SELECT * FROM rewards WHERE quality = 1) c
  FULL JOIN (SELECT * FROM rewards WHERE quality = 0) r ON c.source = r.source AND c.pair = r.pair
)"""

CANDIDATES = """
candidates AS (SELECT user_id AS group_id, event_id AS item_id, value / 100 AS score FROM events)"""


def softmax(source: str, name: str, temperature: float) -> str:
    weight = f"exp((score - max(score) OVER (PARTITION BY group_id)) / {temperature}::DOUBLE)"
    return f"""
{name}_w AS (SELECT *, {weight} AS w FROM {source}),
{name} AS (
  SELECT group_id, item_id, score, w / sum(w) OVER (PARTITION BY group_id) AS prob FROM {name}_w
)"""


def nucleus(source: str, name: str, p: float) -> str:
    return f"""
{name}_m AS (
  SELECT *, coalesce(sum(prob) OVER (PARTITION BY group_id ORDER BY score DESC, item_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS mass FROM {source}
),
{name} AS (SELECT group_id, item_id, score, prob FROM {name}_m WHERE mass < {p})"""


PROBS = "SELECT group_id, item_id, round(score, 6) AS score, round(prob, 6) AS prob"
SUMMARY = (
    "SELECT count(*) AS pairs, count(*) FILTER (loss IS NULL) AS unusable, round(avg(loss), 6) AS mean_loss, "
    "round(avg(correct::INT), 6) AS accuracy FROM scored"
)

ANSWERS = """
answers AS (
  SELECT item_id, text, CASE WHEN item_id % 2 = 0 THEN 'math' ELSE 'choice' END AS task,
    CASE WHEN item_id % 2 = 0 THEN text || ' \\boxed{0} then \\boxed{' || item_id % 7 || '}'
      ELSE text || ' "answer": "' || chr((65 + item_id % 4)::INT) || '"' END AS output,
    CASE WHEN item_id % 2 = 0 THEN (item_id % 5)::VARCHAR ELSE chr((65 + item_id % 3)::INT) END AS gold
  FROM benchmark
),
parsed AS (
  SELECT *,
    list_extract(regexp_extract_all(output, '\\\\boxed\\{((?:[^{}]|\\{[^{}]*\\})*)\\}', 1), -1) AS boxed,
    nullif(regexp_extract(output, '"answer"\\s*:\\s*"([A-Z])"', 1), '') AS letter
  FROM answers
)"""

CASES = """
cases AS (
  SELECT 'item ' || item_id AS name, text AS input,
    CASE WHEN item_id % 5 = 4 THEN 'generate' ELSE 'chat' END AS type,
    CASE WHEN item_id % 5 = 4 THEN 200 + item_id END AS max_length,
    CASE WHEN item_id % 5 = 4 THEN 0.8 END AS temperature
  FROM benchmark
)"""


def two_turns(user: str, system: str = DEFAULT_SYSTEM_PROMPT) -> str:
    return (
        f"'<|im_start|>system' || {NL} || '{system}' || '<|im_end|>' || {NL} || '<|im_start|>user' || {NL}"
        f" || {user} || '<|im_end|>' || {NL} || {GENERATION}"
    )


def any_of(tokens: list[str]) -> str:
    return "|".join(t.replace("|", "\\|") for t in tokens)


def without_special(value: str) -> str:
    return f"regexp_replace({value}, '{any_of(SPECIAL_TOKENS)}', '', 'g')"


ECHOED = f"""
echoed AS (
  SELECT conv_id, prompt, CASE WHEN conv_id % 2 = 0 THEN prompt ELSE '' END
    || chr(8195) || ' answer ' || conv_id || {NL} AS output
  FROM rendered
)"""

TOKEN_IDS = """
token_ids AS (
  SELECT conv_id, turn, list_transform(string_split(text, ' '),
    lambda w, k: CASE WHEN turn % 4 IN (1, 2) AND (k - 1) % 11 = conv_id % 11 THEN 151668 ELSE length(w) END) AS ids
  FROM conversations
),
cuts AS (
  SELECT *, coalesce(list_max(list_filter(range(1, len(ids) + 1), lambda k: ids[k] = 151668)), 0) AS cut
  FROM token_ids
)"""

MODES = f"""
switches AS (
  SELECT conv_id, turn, role, CASE WHEN role IN ('user', 'system')
    THEN list_extract(regexp_extract_all(content, '(?:^|\\s)/(no_think|think)\\b', 1), -1) END AS switch
  FROM marked
),
modes AS (
  SELECT s.conv_id, s.turn, s.role, CASE WHEN (
      SELECT arg_max(e.switch, e.turn) FROM switches e
      WHERE e.conv_id = s.conv_id AND e.turn <= s.turn AND e.switch IS NOT NULL
    ) = 'no_think' THEN 'non_thinking' ELSE 'thinking' END AS mode
  FROM switches s
)"""

PRESETS = "presets(mode, temperature, top_p, top_k, min_p) AS (VALUES " + ", ".join(
    f"('{m}', {t}::DOUBLE, {p}::DOUBLE, {k}, {s}::DOUBLE)" for m, t, p, k, s in SAMPLING_PRESETS
) + ")"
SWEEPS = "configs(config, temperature) AS (VALUES " + ", ".join(
    f"('{n}', {t}::DOUBLE)" for n, t in SWEEP
) + ")"
RUNS = f"""
{SWEEPS},
runs AS (
  SELECT config, 0.1 + {unit("run", "config", "conv_id", "turn")} AS elapsed_s
  FROM conversations CROSS JOIN configs WHERE role = 'user'
)"""

HISTORY = f"""
histories AS (
  SELECT t.conv_id, t.turn, t.i, t.role, t.body, (
      SELECT max(q.i) FROM forms q WHERE q.conv_id = t.conv_id AND q.i < t.i AND q.query
    ) AS lq
  FROM forms t
),
said AS (
  SELECT h.conv_id, h.turn, h.role, h.body, string_agg(
      e.head || CASE WHEN e.role = 'assistant' AND e.i > h.lq AND (e.i = h.i - 1 OR e.reasoning <> '')
        THEN e.long ELSE e.short END, '' ORDER BY e.i) AS past,
    sum(length(e.head || coalesce(e.long, e.short))) AS past_chars
  FROM histories h LEFT JOIN forms e ON e.conv_id = h.conv_id AND e.i < h.i
  GROUP BY ALL
)"""

# The same for prompts that end with the user turn itself.
ASKING = f"""
asking AS (
  SELECT t.conv_id, t.turn, t.i, (
      SELECT max(q.i) FROM forms q WHERE q.conv_id = t.conv_id AND q.i <= t.i AND q.query
    ) AS lq
  FROM forms t WHERE t.role = 'user'
)"""


def stub_answer(prompt: str) -> str:
    return f"'reply ' || length({prompt}) || ' ' || md5({prompt})"


def oracle_sql() -> dict[str, str]:
    token_rows = ", ".join(
        f"({151643 + i}, '{t}', {str(t in SPECIAL_TOKENS).lower()})" for i, t in enumerate(ADDED_TOKENS)
    )
    uses = f"""
found AS (SELECT conv_id, unnest(regexp_extract_all(prompt, '{any_of(ADDED_TOKENS)}')) AS token FROM rendered),
uses AS (SELECT token, count(*) AS uses, count(DISTINCT conv_id) AS turns FROM found GROUP BY token)"""
    return {
        # sources, sinks, dimensions
        "json_dataset_scan": f"""WITH {PAIRS}
            SELECT conv_id || '-' || turn AS pair_id, prompt, chosen, rejected, false AS is_bad FROM judged
            UNION ALL SELECT NULL, NULL, NULL, NULL, true FROM judged WHERE rejected IS NULL""",
        "json_array_scan": f"""WITH {PAIRS}
            SELECT conv_id || '-' || turn AS pair_id, prompt, chosen, rejected, false AS is_bad FROM judged
            UNION ALL SELECT NULL, NULL, NULL, NULL, true FROM judged WHERE rejected IS NULL""",
        "test_cases": f"""WITH {CASES} SELECT name, input, type, max_length::DOUBLE AS max_length,
            temperature::DOUBLE AS temperature FROM cases""",
        "cap_rows": "SELECT doc_id, source FROM documents ORDER BY md5('7|' || doc_id), doc_id LIMIT 500",
        "special_token_dim": f"""{CHAT}, {uses}, dim(id, token, special) AS (VALUES {token_rows})
            SELECT d.id, d.token, d.special, coalesce(u.uses, 0)::BIGINT AS uses
            FROM dim d LEFT JOIN uses u USING (token)""",
        "sampling_presets": f"""WITH {MARKED}, {MODES}, {PRESETS}
            SELECT p.mode, temperature, top_p, top_k, min_p, count(m.conv_id) AS turns
            FROM presets p LEFT JOIN modes m USING (mode) GROUP BY ALL""",
        "run_report": f"""WITH {CASES}, prompts AS (
              SELECT name, CASE WHEN type = 'chat' THEN {two_turns("input")} ELSE input END AS prompt FROM cases)
            SELECT name, CASE WHEN prompt LIKE '%z%' THEN NULL ELSE {stub_answer("prompt")} END AS output,
              CASE WHEN prompt LIKE '%z%' THEN 'ValueError: no z please' END AS error, true AS timed FROM prompts""",
        "messages_scan": f"""WITH {MARKED}
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn, role, content,
              aside AS reasoning_content, CASE WHEN calls >= 1 THEN 'lookup={{"k": ' || conv_id || '}}'
                || CASE WHEN calls = 2 THEN ';again={{"k": ' || conv_id || '}}' ELSE '' END END AS calls,
              CASE WHEN {HAS_TOOLS} THEN '{{"name": "lookup"}}' || {NL} || '{{"name": "again"}}' END AS tools
            FROM marked""",
        # projections and filters
        "dispatch_prompts": f"""WITH {CASES} SELECT name,
            CASE WHEN type = 'chat' THEN {two_turns("input")} ELSE input END AS prompt FROM cases""",
        "resolve_params": f"""WITH {CASES} SELECT name, coalesce(max_length, 512)::INT AS max_length,
            coalesce(temperature, 0.7)::DOUBLE AS temperature, 0.9::DOUBLE AS top_p, true AS do_sample FROM cases""",
        "drop_empty_turns": f"""WITH {EXITS} SELECT conv_id, turn, role, content FROM exits
            WHERE NOT (role = 'user' AND trim(content, {BLANKS}) = '')""",
        "take_until_exit": f"""WITH {EXITS}, closed AS (
              SELECT conv_id, min(turn) AS closed FROM exits
              WHERE role = 'user' AND lower(trim(content, {BLANKS})) IN ('quit', 'exit', '退出') GROUP BY conv_id)
            SELECT e.conv_id, e.turn, e.role, e.content FROM exits e LEFT JOIN closed c USING (conv_id)
            WHERE c.closed IS NULL OR e.turn < c.closed""",
        "validate_turns": f"""WITH {MARKED}, per_place AS (SELECT conv_id, turn, count(*) AS n FROM marked GROUP BY ALL)
            SELECT count(*) AS turns, count(*) FILTER (WHERE conv_id IS NULL OR turn IS NULL) AS no_place,
              count(*) FILTER (WHERE role IS NULL) AS no_role,
              count(*) FILTER (WHERE role NOT IN ('system', 'user', 'assistant', 'tool')) AS unknown_role,
              count(*) FILTER (WHERE content IS NULL) AS no_content,
              (SELECT sum(n - 1)::BIGINT FROM per_place) AS repeated_place
            FROM marked""",
        # strings
        "two_turn_prompt": f"""SELECT conv_id, turn, {two_turns("text")} AS prompt
            FROM conversations WHERE role = 'user'""",
        "unicode_strip": f"""WITH {EXITS}
            SELECT conv_id, turn, trim(content || chr(8239) || {NL}, {BLANKS}) AS stripped FROM exits""",
        "strip_echo": f"""{CHAT}, {ECHOED}
            SELECT conv_id, trim(CASE WHEN starts_with(output, prompt)
              THEN substring(output, length(prompt) + 1) ELSE output END, {BLANKS}) AS answer FROM echoed""",
        "clean_output": f"""{CHAT}, {ECHOED} SELECT conv_id, 'answer ' || conv_id AS answer FROM echoed""",
        "strip_special_tokens": f"""{CHAT} SELECT conv_id, {without_special("prompt")} AS clean FROM rendered""",
        "split_reasoning": f"""WITH {MARKED}, {PLACED}
            SELECT conv_id, turn, reasoning, answer FROM parted WHERE role = 'assistant'""",
        "split_reasoning_ids": f"""WITH {TOKEN_IDS} SELECT conv_id, turn,
              array_to_string(ids[1:cut], ' ') AS reasoning_ids, array_to_string(ids[cut + 1:], ' ') AS answer_ids
            FROM cuts""",
        "standardise_prompt": f"""WITH {ANSWERS} SELECT item_id, text || {NL} || CASE task
              WHEN 'math' THEN {text(TASK_INSTRUCTIONS["math"])} ELSE {text(TASK_INSTRUCTIONS["choice"])} END AS prompt
            FROM answers""",
        "extract_boxed": f"WITH {ANSWERS} SELECT item_id, boxed FROM parsed",
        "extract_boxed_nested": r"""SELECT item_id,
              repeat('\sqrt{', (item_id % 10)::INT) || item_id || repeat('}', (item_id % 10)::INT) AS boxed FROM benchmark""",
        "answer_equivalence": """WITH f AS (
              SELECT item_id, item_id % 7 + 1 AS p, list_extract([2, 4, 5, 8], (item_id % 4 + 1)::INT) AS q, (item_id // 4) % 4 AS kind FROM benchmark),
            g AS (SELECT *, CASE WHEN kind = 3 THEN p + q ELSE p END AS t FROM f),
            r AS (SELECT item_id, kind, t // gcd(t, q) AS a, q // gcd(t, q) AS b, p // gcd(p, q) AS c, q // gcd(p, q) AS d FROM g)
            SELECT item_id, a || CASE WHEN b > 1 THEN '/' || b ELSE '' END AS canonical, c || CASE WHEN d > 1 THEN '/' || d ELSE '' END AS gold,
              (SELECT round(avg((kind <> 3)::INT), 6) FROM r) AS accuracy FROM r""",
        "extract_choice": f"WITH {ANSWERS} SELECT item_id, letter AS choice FROM parsed",
        "control_token_scan": f"{CHAT}, {uses} SELECT token, uses, turns FROM uses",
        "token_table_scan": """WITH held AS (
              SELECT conv_id, turn, (conv_id * 7 + turn * 3) % 7000 AS n, true AS closed FROM conversations
              UNION ALL SELECT conv_id, turn, (conv_id * 5 + turn) % 7000, false FROM conversations),
            known AS (SELECT conv_id, turn, CASE WHEN n < 5000 THEN '<|extra_' || n || CASE WHEN closed THEN '|>' ELSE '' END
                -- of a number beyond the table, its longest beginning that is in it
                ELSE '<|extra_' || (n // 10) END AS token FROM held)
            SELECT token, count(*) AS uses, count(DISTINCT (conv_id, turn)) AS turns FROM known GROUP BY token""",
        "extract_tool_calls": f"""{CHAT}, bodies AS (
              SELECT conv_id, turn, unnest(range(0, len(b))) AS call, unnest(b) AS body FROM (
                SELECT conv_id, turn, regexp_extract_all(segment, '(?s)<tool_call>\\n(.*?)\\n</tool_call>', 1) AS b
                FROM segments WHERE role = 'assistant'))
            SELECT conv_id, turn, call::INT AS call, json_extract_string(body, '$.name') AS name,
              json_extract_string(body, '$.arguments.k') AS k FROM bodies""",
        "length_budget": f"""{CHAT}, {ECHOED}, sized AS (
              SELECT conv_id, greatest(least(6000 - length(prompt), 30, 32768 - length(prompt)), 0) AS room,
                string_split(output, ' ') AS words FROM echoed)
            SELECT conv_id, room::INT AS room, room > 0 AS fits, array_to_string(words[1:room], ' ') AS kept FROM sized""",
        # rendering
        "render_conversation": f"{CHAT} SELECT conv_id, 0::BIGINT AS prompt_start, prompt FROM rendered",
        "render_plain": f"""WITH ranked AS (
              SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1 AS is_last,
                max(turn) FILTER (WHERE role = 'user') OVER (PARTITION BY conv_id) AS lq FROM conversations)
            SELECT conv_id, 0::BIGINT AS prompt_start, string_agg('<|im_start|>' || role || {NL} || CASE
                WHEN role = 'assistant' AND is_last AND turn > lq
                THEN '<think>' || {NL} || {NL} || '</think>' || {NL} || {NL} || ltrim(text, {NL})
                ELSE text END || '<|im_end|>' || {NL}, '' ORDER BY turn) AS prompt
            FROM ranked GROUP BY conv_id""",
        "render_in_cells": f"""{CHAT}, offsets AS (
              SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id ORDER BY i
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM segments)
            SELECT conv_id, min(start)::BIGINT AS prompt_start, string_agg(segment, '' ORDER BY i) AS prompt
            FROM offsets GROUP BY conv_id, floor(start / 1000)""",
        "render_tools_head": f"""WITH {MARKED}, {PLACED}
            SELECT conv_id, head FROM forms WHERE i = 0 AND conv_id % 6 = 1""",
        "last_query_index": f"WITH {MARKED}, {PLACED} SELECT conv_id, last_query_index FROM asked",
        "prune_history_reasoning": f"""{CHAT}
            SELECT conv_id, turn, segment FROM segments WHERE role = 'assistant'""",
        "render_tool_calls": f"WITH {MARKED}, {PLACED} SELECT conv_id, turn, call_text FROM called WHERE calls > 0",
        "render_tool_results": f"{CHAT} SELECT conv_id, turn, segment FROM segments WHERE role = 'tool'",
        "render_generation_prompt": f"""{CHAT} SELECT conv_id, 0::BIGINT AS prompt_start,
              prompt || {GENERATION} || CASE WHEN conv_id % 2 = 0
                THEN '<think>' || {NL} || {NL} || '</think>' || {NL} || {NL} ELSE '' END AS prompt
            FROM rendered""",
        # windows
        "number_turns": """SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS number,
              count(*) OVER (PARTITION BY conv_id) AS of FROM conversations""",
        "thinking_mode_flagged": f"""WITH {MARKED}, {MODES} SELECT conv_id, turn, role,
              CASE WHEN conv_id % 3 <> 0 AND conv_id % 2 = 0 THEN 'non_thinking' ELSE mode END AS mode FROM modes""",
        "thinking_mode": f"WITH {MARKED}, {MODES} SELECT conv_id, turn, role, mode FROM modes",
        "history_examples": f"""WITH {MARKED}, {PLACED}, {HISTORY}
            SELECT conv_id, turn, coalesce(past_chars, 0)::BIGINT AS history_chars,
              coalesce(past, '') || {GENERATION} AS prompt, body AS response FROM said WHERE role = 'assistant'""",
        "history_spans": f"""WITH {MARKED}, {PLACED}, {HISTORY}, asked_chars AS (
              SELECT h.conv_id, h.turn, h.i, h.lq, sum(length(e.head || e.short)) FILTER (h.lq IS NULL OR e.i <= h.lq) AS short_chars
              FROM histories h LEFT JOIN forms e ON e.conv_id = h.conv_id AND e.i < h.i WHERE h.role = 'assistant' GROUP BY ALL)
            SELECT a.conv_id, a.turn, coalesce(a.short_chars, 0)::BIGINT AS short_chars,
              CASE WHEN b.role = 'assistant' AND b.i > a.lq THEN b.turn END AS before_turn,
              (length(coalesce(s.past, '')) + length({GENERATION}))::BIGINT AS prompt_chars
            FROM asked_chars a JOIN said s USING (conv_id, turn)
            LEFT JOIN forms b ON b.conv_id = a.conv_id AND b.i = a.i - 1""",
        "qa_pairs": f"WITH {PAIRS} SELECT conv_id, turn, prompt, answer FROM qa",
        # joins
        "config_sweep": f"""WITH {SWEEPS} SELECT conv_id, turn, config, temperature
            FROM conversations CROSS JOIN configs WHERE role = 'user'""",
        "preset_lookup": f"""WITH {MARKED}, {MODES}, {PRESETS}
            SELECT conv_id, turn, mode, temperature, top_p, top_k, min_p FROM modes JOIN presets USING (mode)""",
        # aggregations
        "loss_bearing_totals": """SELECT conv_id, sum(length(text))::BIGINT AS chars,
              coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars
            FROM conversations GROUP BY conv_id""",
        "latency_summary": f"""WITH {RUNS} SELECT config, count(*) AS runs, round(avg(elapsed_s), 6) AS mean_s,
              round(max(elapsed_s), 6) AS max_s, round(quantile_disc(elapsed_s, 0.5), 6) AS p50_s,
              round(quantile_disc(elapsed_s, 0.95), 6) AS p95_s FROM runs GROUP BY config""",
        "latency_sketches": f"""WITH {RUNS} SELECT config, count(*) AS runs, round(avg(elapsed_s), 6) AS mean_s,
              round(max(elapsed_s), 6) AS max_s, true AS p50_s_near, true AS p95_s_near FROM runs GROUP BY config""",
        "answer_accuracy": f"""WITH {ANSWERS}, judged AS (
              SELECT task, gold, CASE WHEN task = 'math' THEN boxed ELSE letter END AS predicted FROM parsed)
            SELECT task, count(*) AS answers, count(predicted) AS parsed,
              round(avg(coalesce(predicted = gold, false)::INT), 6) AS accuracy FROM judged GROUP BY task""",
        # candidates
        "temperature_softmax": f"WITH {CANDIDATES}, {softmax('candidates', 'p', 0.7)} {PROBS} FROM p",
        "top_k": f"""WITH {CANDIDATES} SELECT group_id, item_id, round(score, 6) AS score FROM candidates
            QUALIFY rank() OVER (PARTITION BY group_id ORDER BY score DESC) <= 20""",
        "top_p_off": f"WITH {CANDIDATES}, {softmax('candidates', 's', 0.7)} {PROBS} FROM s",
        "top_k_with_gaps": f"""WITH {CANDIDATES} SELECT group_id, item_id, round(score, 6) AS score FROM candidates
            WHERE item_id % 7 <> 3 AND item_id % 11 <> 5
            QUALIFY rank() OVER (PARTITION BY group_id ORDER BY score DESC) <= 20""",
        "top_p": f"""WITH {CANDIDATES}, {softmax('candidates', 's', 0.7)}, {nucleus('s', 'kept', 0.9)}
            {PROBS} FROM kept""",
        "min_p": f"""WITH {CANDIDATES}, {softmax('candidates', 's', 0.7)}
            {PROBS} FROM s QUALIFY prob >= 0.05 * max(prob) OVER (PARTITION BY group_id)""",
        "greedy_pick": f"""WITH {CANDIDATES} SELECT group_id, item_id, round(score, 6) AS score FROM candidates
            QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY score DESC, item_id) = 1""",
        "weighted_pick": f"""WITH {CANDIDATES}, {softmax('candidates', 's', 0.7)}, lucky AS (
              SELECT *, ln(prob) - ln(-ln({unit("draw", "group_id", "item_id")})) AS luck FROM s)
            SELECT group_id, item_id FROM lucky
            QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY luck DESC, item_id) = 1""",
        "mark_seen": """SELECT user_id AS group_id, event_id AS item_id, round(value / 100, 6) AS score,
              event_type = 'purchase' AS seen FROM events""",
        "unseen_candidates": """SELECT user_id AS group_id, event_id AS item_id, round(value / 100, 6) AS score
            FROM events WHERE event_type <> 'purchase'""",
        "repetition_penalty": """SELECT user_id AS group_id, event_id AS item_id, round(CASE
              WHEN event_type <> 'purchase' THEN value / 100 - 2
              WHEN value / 100 - 2 < 0 THEN (value / 100 - 2) * 1.1 ELSE (value / 100 - 2) / 1.1 END, 6) AS score
            FROM events""",
        "presence_penalty": """SELECT user_id AS group_id, event_id AS item_id,
              round(value / 100 - CASE WHEN event_type = 'purchase' THEN 1.5 ELSE 0 END, 6) AS score FROM events""",
        "select_candidates": f"""WITH {CANDIDATES}, shortlist AS (
              SELECT * FROM candidates QUALIFY rank() OVER (PARTITION BY group_id ORDER BY score DESC) <= 20),
            {softmax('shortlist', 's', 0.6)}, {nucleus('s', 'kept', 0.95)}, solid AS (
              SELECT * FROM kept QUALIFY prob >= 0.02 * max(prob) OVER (PARTITION BY group_id))
            SELECT group_id, item_id, round(score, 6) AS score,
              round(prob / sum(prob) OVER (PARTITION BY group_id), 6) AS prob FROM solid""",
        "sample_candidates": f"""WITH pushed AS (
              SELECT user_id AS group_id, event_id AS item_id, CASE WHEN event_type <> 'purchase' THEN value / 100
                WHEN value < 0 THEN value / 100 * 1.1 - 0.25 ELSE value / 100 / 1.1 - 0.25 END AS score FROM events),
            shortlist AS (SELECT * FROM pushed QUALIFY rank() OVER (PARTITION BY group_id ORDER BY score DESC) <= 50),
            {softmax('shortlist', 's', 0.7)}, {nucleus('s', 'kept', 0.9)}, shares AS (
              SELECT group_id, item_id, score, prob / sum(prob) OVER (PARTITION BY group_id) AS prob FROM kept)
            {PROBS} FROM shares QUALIFY row_number() OVER (PARTITION BY group_id
              ORDER BY ln(prob) - ln(-ln({unit("chain", "group_id", "item_id")})) DESC, item_id) = 1""",
        # generation with a stub
        "batch_generate": f"""WITH asked AS (
              SELECT conv_id, turn, {two_turns("text")} AS prompt FROM conversations WHERE role = 'user')
            SELECT conv_id, turn, CASE WHEN prompt LIKE '%z%' THEN NULL ELSE {stub_answer("prompt")} END AS output,
              CASE WHEN prompt LIKE '%z%' THEN 'ValueError: no z please' END AS error FROM asked""",
        "resume_generate": f"""WITH asked AS (
              SELECT conv_id, turn, {two_turns("text")} AS prompt FROM conversations WHERE role = 'user')
            SELECT conv_id, turn, CASE WHEN prompt LIKE '%z%' THEN NULL ELSE {stub_answer("prompt")} END AS output,
              CASE WHEN prompt LIKE '%z%' THEN 'ValueError: no z please' END AS error,
              ('0x' || substring(sha256('{{"prompt":"' || replace(replace(replace(prompt, chr(92), chr(92) || chr(92)), '"', chr(92) || '"'), chr(10), chr(92) || 'n') || '"}}'), 1, 8))::BIGINT % 5 < 2 AS at_first
            FROM asked""",
        # streams
        "stream_take_until_exit": f"""WITH {EXITS}, spoken AS (
              SELECT * FROM exits WHERE NOT (role = 'user' AND trim(content, {BLANKS}) = '')),
            closed AS (SELECT conv_id, min(turn) AS closed FROM spoken
              WHERE role = 'user' AND lower(trim(content, {BLANKS})) IN ('quit', 'exit', '退出') GROUP BY conv_id)
            SELECT s.conv_id, s.turn, s.role, s.content FROM spoken s LEFT JOIN closed c USING (conv_id)
            WHERE c.closed IS NULL OR s.turn < c.closed""",
        "stream_history_prompt": f"""WITH {MARKED}, {PLACED}, {ASKING}
            SELECT h.conv_id, h.turn, string_agg(e.head || CASE WHEN e.role = 'assistant' AND e.i > h.lq AND e.reasoning <> ''
                THEN e.long ELSE e.short END, '' ORDER BY e.i) || {GENERATION} AS prompt
            FROM asking h JOIN forms e ON e.conv_id = h.conv_id AND e.i <= h.i GROUP BY h.conv_id, h.turn""",
        "stream_late_turns": f"""WITH {MARKED}, {PLACED}, {ASKING}
            SELECT h.conv_id, h.turn, string_agg(e.head || CASE WHEN e.role = 'assistant' AND e.i > h.lq AND e.reasoning <> ''
                THEN e.long ELSE e.short END, '' ORDER BY e.i) || {GENERATION} AS prompt
            FROM asking h JOIN forms e ON e.conv_id = h.conv_id AND e.i <= h.i GROUP BY h.conv_id, h.turn""",
        "stream_latest_response": """SELECT conv_id, role, arg_max(text, turn) AS latest, count(*) AS updates
            FROM conversations GROUP BY conv_id, role""",
        # stages
        "pack_corpus": """WITH n AS (SELECT greatest(1, ceil(sum(length(text)) / 4000000))::BIGINT AS shards FROM documents),
            placed AS (SELECT doc_id, doc_id % shards AS shard, text FROM documents, n),
            shards AS (SELECT shard, string_agg(text || '<|endoftext|>', '' ORDER BY doc_id) AS body FROM placed GROUP BY 1),
            places AS (SELECT shard, sum(length(text) + 13) OVER (PARTITION BY shard ORDER BY doc_id) AS stop,
                length(text) + 13 AS size FROM placed),
            blocks AS (SELECT shard, unnest(range(0, CAST(ceil(length(body) / 4096) AS BIGINT))) AS block, body FROM shards)
            SELECT b.shard, b.block, substring(any_value(b.body), b.block * 4096 + 1, 4096) AS text, count(*) AS documents
            FROM blocks b JOIN places p ON p.shard = b.shard AND p.stop > b.block * 4096
              AND p.stop - p.size < (b.block + 1) * 4096
            GROUP BY b.shard, b.block""",
        "pack_examples": """WITH words AS (SELECT conv_id * 1000 + turn AS example_id, string_split(text, ' ') AS w FROM conversations),
            numbered AS (SELECT example_id, len(w) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words)
            SELECT example_id, count(*) AS n_ids, sum(('0x' || substring(md5(word), 1, 4))::BIGINT * i)::BIGINT AS weighted,
              1::BIGINT AS n_sequences, any_value(n) <= 512 AS fits FROM numbered GROUP BY example_id""",
        "sft_examples": f"""{CHAT}, offsets AS (
              SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id ORDER BY i
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS loss_start FROM segments)
            SELECT o.conv_id, o.turn, o.loss_start, length(o.segment)::BIGINT AS loss_chars,
              substring(r.prompt, o.loss_start + 1, length(o.segment)) AS segment
            FROM offsets o JOIN rendered r USING (conv_id) WHERE o.role = 'assistant'""",
        "preference_pairs": f"""WITH {PAIRS}, usable AS (
              SELECT * FROM judged WHERE length(prompt) > 0 AND length(chosen) > 0
                AND length(rejected) > 0 AND chosen <> rejected)
            SELECT conv_id, turn, prompt, chosen, rejected FROM usable
            QUALIFY row_number() OVER (PARTITION BY prompt, chosen, rejected ORDER BY conv_id, turn) = 1""",
        "dpo_scores": f"""WITH {DPO} SELECT conv_id, turn, round(margin, 6) AS margin,
            round(loss, 6) AS loss, correct FROM scored""",
        "dpo_summary": f"WITH {DPO} {SUMMARY}",
        "orpo_scores": f"""WITH {ORPO} SELECT conv_id, turn, round(log_odds_ratio, 6) AS log_odds_ratio,
            round(loss, 6) AS loss, correct FROM scored""",
        "orpo_summary": f"WITH {ORPO} {SUMMARY}",
        "reward_pair_accuracy": f"""WITH {REWARDS} SELECT count(loss) AS pairs, round(avg(loss), 6) AS mean_loss,
              round(avg(correct::INT), 6) AS accuracy, count(*) FILTER (loss IS NULL) AS unpaired, 0::BIGINT AS repeated
            FROM scored""",
        "reward_intervals": f"""WITH {REWARDS}, judged AS (
              SELECT c.source, c.pair, {loss("c.reward - r.reward")} AS loss, (c.reward > r.reward)::INT::DOUBLE AS won
              FROM rewards c JOIN rewards r ON c.source = r.source AND c.pair = r.pair AND c.quality = 1 AND r.quality = 0),
            drawn AS (SELECT j.*, n, ('0x' || substring(md5('boot|0|' || (n // 6) || '|' || source || '|' || pair), 1 + 12 * ((n % 6) // 3), 12))::BIGINT AS h
              FROM judged j, range(24) t(n)),
            weighted AS (SELECT *, len(list_filter([{", ".join(map(str, POISSON))}], lambda s: ((h >> (16 * (n % 3))::INT) & 65535) >= s)) AS w FROM drawn),
            means AS (SELECT source, n, sum(w * loss) / nullif(sum(w), 0) AS loss, sum(w * won) / nullif(sum(w), 0) AS won FROM weighted GROUP BY ALL),
            ends AS (SELECT source, min(loss) AS ll, max(loss) AS lh, min(won) AS wl, max(won) AS wh FROM means GROUP BY source)
            SELECT source, count(*) AS rows, round(avg(loss), 6) AS loss_mean, round(any_value(ll), 6) AS loss_low, round(any_value(lh), 6) AS loss_high,
              round(avg(won), 6) AS right_mean, round(any_value(wl), 6) AS right_low, round(any_value(wh), 6) AS right_high
            FROM judged JOIN ends USING (source) GROUP BY source""",
        "reward_ranking": f"""WITH {REWARDS}, r AS (SELECT source, quality, round(reward, 1) AS reward FROM rewards),
            sides AS (SELECT source, count(*) FILTER (quality = 1) AS positives, count(*) FILTER (quality = 0) AS negatives FROM r GROUP BY source),
            won AS (SELECT a.source, avg(CASE WHEN a.reward > b.reward THEN 1.0 WHEN a.reward = b.reward THEN 0.5 ELSE 0 END) AS auc
              FROM r a JOIN r b ON a.source = b.source AND a.quality = 1 AND b.quality = 0 GROUP BY a.source)
            SELECT source, positives, negatives, round(auc, 6) AS auc FROM sides LEFT JOIN won USING (source)""",
        "kl_shaped_reward": f"""WITH tokens AS (
              SELECT doc_id, unnest(range(0, 16)) AS pos FROM documents WHERE doc_id % 23 <> 7),
            drift AS (SELECT doc_id, sum(-(0.1 + 3 * {unit("pi", "doc_id", "pos")})
                + (0.1 + 3 * {unit("ref", "doc_id", "pos")})) AS drifted FROM tokens GROUP BY doc_id),
            every AS (SELECT doc_id, coalesce(drifted, 0) AS kl FROM documents LEFT JOIN drift USING (doc_id))
            SELECT doc_id AS seq_id, round(4 * {unit("seq", "doc_id")} - 2, 6) AS reward, round(kl, 6) AS kl,
              round(4 * {unit("seq", "doc_id")} - 2 - 0.05 * kl, 6) AS shaped_reward FROM every""",
        "group_advantage": """SELECT user_id, event_id, round(
              (value - avg(value) OVER w) / (coalesce(stddev_samp(value) OVER w, 0) + 0.0001), 6) AS advantage
            FROM events WINDOW w AS (PARTITION BY user_id)""",
        "distill_loss": f"""WITH items AS (
              SELECT vec_id AS pos, label, unnest(range(0, len(embedding))) AS item,
                unnest(embedding)::DOUBLE * 8 AS teacher FROM embeddings),
            unmasked AS (SELECT * FROM items WHERE NOT (item = pos % 5 AND item <> label)),
            logits AS (SELECT *, teacher + {unit("student", "pos", "item")} - 0.5 AS student FROM unmasked),
            logs AS (SELECT pos, item = label AS gold,
              teacher - ln(sum(exp(teacher)) OVER (PARTITION BY pos)) AS lt,
              student - ln(sum(exp(student)) OVER (PARTITION BY pos)) AS ls FROM logits),
            terms AS (SELECT pos, sum(exp(lt) * (lt - ls)) AS kl, -max(ls) FILTER (WHERE gold) AS ce FROM logs GROUP BY pos)
            SELECT pos, round(kl, 6) AS kl, round(ce, 6) AS cross_entropy, round(0.7 * kl + 0.3 * ce, 6) AS loss FROM terms""",
    }

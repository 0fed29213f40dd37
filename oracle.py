"""SQL counterparts of the registered queries, for DuckDB over the same tables.

Independent of the Spark code: merging is a recursive query over symbol rows, vectors are lists,
and loops are unrolled into chains of common table expressions.
"""

from __future__ import annotations

from weftmill.fixtures import MODEL_TABLES, SEED_PARTS, TABLE_CODE_WPE, TABLE_CODE_WTE, value_sql

BLANK = r"\t\n\x0B\f\r \x{85}\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}"
PATTERN = r"''s|''t|''re|''ve|''m|''ll|''d| ?[\p{L}\p{N}_]+| ?[^" + BLANK + r"\p{L}\p{N}_]+|[" + BLANK + "]+"
# Places of the model over text: one per byte of the longest prompt, and those that are generated.
TEXT_PLACES = "(SELECT max(strlen(text)) + 10 FROM conversations)"
GREEDY_STEPS = 3
SAMPLED_STEPS = 3
SAMPLED_EOS = 171
PROMPT_STEPS = 10
D, HEADS, FF, BLOCKS, PLACES = 64, 4, 256, 2, 64

Ctes = list[tuple[str, str]]


def with_(ctes: Ctes, select: str, recursive: bool = False) -> str:
    seen: dict[str, str] = {}
    for name, body in ctes:
        seen.setdefault(name, body)

    def head(name: str) -> str:
        return name if "(" in name else f"{name} AS MATERIALIZED"

    parts = [f"{head(n)} {'AS ' if '(' in n else ''}(\n{b}\n)" for n, b in seen.items()]
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + f"\n{select}"


# --- Text ------------------------------------------------------------------------------------

ENCODER = """
SELECT b AS byte, printf('%02X', b) AS hx,
       chr((CASE WHEN b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b BETWEEN 174 AND 255 THEN b
                 WHEN b < 33 THEN 256 + b WHEN b = 173 THEN 256 + 67 ELSE 256 + b - 127 + 33 END)::INT)
         AS character
FROM range(256) t(b)"""


def occurrences(table: str, ids: str) -> str:
    return f"""
SELECT {ids}, unnest(p) AS part, generate_subscripts(p, 1) AS part_position
FROM (SELECT {ids}, regexp_extract_all(text, '{PATTERN}') AS p FROM {table})"""


def symbols(parts: str) -> str:
    return f"""
SELECT part, i AS position, e.character AS symbol
FROM (SELECT part, hex(encode(part)) AS h, unnest(range(1, octet_length(encode(part)) + 1)) AS i FROM {parts}) x
JOIN enc e ON e.hx = substr(x.h, (2 * i - 1)::INT, 2)"""


def text_ctes(table: str = "documents", ids: str = "doc_id", words: str = "documents") -> Ctes:
    """Vocabulary from the texts of `words`, and occurrences `occ` and final symbols `fin` of `table`."""
    return [
        ("enc", ENCODER),
        ("doc_occ", occurrences(words, "1 AS one")),
        ("doc_parts", "SELECT part, count(*) AS n FROM doc_occ GROUP BY part"),
        ("top_parts", f"SELECT part FROM doc_parts ORDER BY n DESC, part LIMIT {SEED_PARTS}"),
        ("top_symbols", symbols("top_parts")),
        (
            "prefixes",
            """SELECT DISTINCT array_to_string(s[1:k], '') AS cluster
               FROM (SELECT s, unnest(range(2, len(s) + 1)) AS k
                     FROM (SELECT list(symbol ORDER BY position) AS s FROM top_symbols GROUP BY part))""",
        ),
        (
            "vocab",
            """SELECT byte AS token, character AS cluster FROM enc UNION ALL
               SELECT 255 + row_number() OVER (ORDER BY length(cluster), cluster), cluster FROM prefixes""",
        ),
        ("occ", occurrences(table, ids)),
        ("parts", "SELECT DISTINCT part FROM occ"),
        (
            "bpe(part, step, position, symbol, token)",
            f"""SELECT part, 1::BIGINT, position, symbol, NULL::BIGINT FROM ({symbols('parts')})
                UNION ALL
                SELECT part, step + 1, position, CASE WHEN starts THEN symbol || nxt ELSE symbol END, best
                FROM (SELECT *, lag(starts) OVER (PARTITION BY part ORDER BY rn) AS swallowed
                      FROM (SELECT *, hit AND row_number() OVER (PARTITION BY part, hit, grp ORDER BY rn) % 2 = 1 AS starts
                            FROM (SELECT *, rn - row_number() OVER (PARTITION BY part, hit ORDER BY rn) AS grp
                                  FROM (SELECT *, coalesce(token = best, false) AS hit
                                        FROM (SELECT p.*, v.token, min(v.token) OVER (PARTITION BY part) AS best
                                              FROM (SELECT part, step, position, symbol,
                                                           lead(symbol) OVER (PARTITION BY part ORDER BY position) AS nxt,
                                                           row_number() OVER (PARTITION BY part ORDER BY position) AS rn
                                                    FROM bpe) p
                                              LEFT JOIN vocab v ON v.cluster = p.symbol || p.nxt)
                                        WHERE best IS NOT NULL))))
                WHERE NOT coalesce(swallowed, false)""",
        ),
        (
            "fin",
            """SELECT part, row_number() OVER (PARTITION BY part ORDER BY position) AS position, symbol AS cluster
               FROM (SELECT * FROM bpe QUALIFY step = max(step) OVER (PARTITION BY part))""",
        ),
        ("tok", "SELECT fin.part, fin.position, v.token, fin.cluster FROM fin JOIN vocab v ON v.cluster = fin.cluster"),
        (
            "vocab_hex",
            """SELECT token, string_agg(e.hx, '' ORDER BY i) AS h
               FROM (SELECT token, cluster, unnest(range(1, length(cluster) + 1)) AS i FROM vocab) x
               JOIN enc e ON e.character = substr(cluster, i::INT, 1) GROUP BY token""",
        ),
    ]


def text_query(select: str, table: str = "documents", ids: str = "doc_id") -> str:
    return with_(text_ctes(table, ids), select, recursive=True)


def stats_query(table: str, ids: str, by: str) -> str:
    return text_query(
        f"""SELECT {by}, n_texts, n_chars, coalesce(n_tokens, 0) AS n_tokens, coalesce(n_distinct, 0) AS n_distinct,
                   round(coalesce(n_tokens, 0)::DOUBLE / n_chars, 6) + 0.0 AS tokens_per_char
            FROM (SELECT {by}, count(*) AS n_texts, sum(length(text))::BIGINT AS n_chars FROM {table} GROUP BY {by}) a
            LEFT JOIN (SELECT {by}, count(*) AS n_tokens, count(DISTINCT token) AS n_distinct
                       FROM occ JOIN tok USING (part) GROUP BY {by}) b USING ({by})""",
        table,
        f"{ids}, {by}",
    )


def sequence_query(table: str, ids: str) -> str:
    return text_query(
        f"""SELECT {ids}, count(*) AS n_seq,
                   string_agg(token::VARCHAR, ' ' ORDER BY part_position, position) AS input
            FROM occ JOIN tok USING (part) GROUP BY {ids}""",
        table,
        ids,
    )


DECODED = """
SELECT doc_id, decode(unhex(string_agg(h, '' ORDER BY part_position, position))) AS response
FROM occ JOIN tok USING (part) JOIN vocab_hex USING (token) GROUP BY doc_id"""


# --- Vectors and stages ----------------------------------------------------------------------

EMB: Ctes = [("emb", "SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings")]


def rounded(x: str) -> str:
    return f"round({x}, 6) + 0.0"


def long(keys: str, source: str, values: str = "values") -> str:
    return f"""SELECT {keys}, i, {rounded('value')} AS value
FROM (SELECT {keys}, unnest("{values}") AS value, generate_subscripts("{values}", 1) - 1 AS i FROM {source})"""


def zip_sql(a: str, b: str, op: str) -> str:
    return f"list_transform(list_zip({a}, {b}), lambda t: t[1] {op} t[2])"


def gelu_sql(v: str) -> str:
    return (
        f"list_transform({v}, lambda t: 0.5::DOUBLE * t * (1 + tanh(0.797884560802::DOUBLE"
        " * (t + 0.044715::DOUBLE * t * t * t))))"
    )


def vector_query(expr: str) -> str:
    return with_([*EMB, ("r", f'SELECT vec_id, {expr} AS "values" FROM emb')], long("vec_id", "r"))


def formula(k: int, block: str, row: str, width: int, offset: float, scale: float) -> str:
    cell = value_sql(k, block, row, "j")
    return (
        f"list_transform(range({width}), lambda j: {offset}::DOUBLE + {scale}::DOUBLE * ({cell} / 1001.0::DOUBLE))"
    )


def model_ctes() -> Ctes:
    size = {"d": D, "3d": 3 * D, "f": FF}
    out: Ctes = []
    for name, (k, rows, cols, offset, scale, per_block) in MODEL_TABLES.items():
        n_rows, n_blocks = size[rows] if rows else 1, BLOCKS if per_block else 1
        value = formula(k, "b", "r", size[cols], offset, scale)
        out.append(
            (name, f'SELECT b, r, {value} AS "values" FROM range({n_blocks}) x(b), range({n_rows}) y(r)')
        )
    return out


def wpe_cte(n: int) -> tuple[str, str]:
    value = formula(TABLE_CODE_WPE, "0", "r", D, 0.0, 0.1)
    return ("wpe", f'SELECT r AS place, {value} AS "values" FROM range({n}) y(r)')


WTE: tuple[str, str] = ("wte", 'SELECT vec_id AS token, v AS "values" FROM emb')
SEQ: tuple[str, str] = (
    "seq",
    """SELECT vec_id // 10 AS seq_id, vec_id % 10 AS place,
              (vec_id * 37 + 11) % (SELECT count(*) FROM embeddings) AS token FROM emb""",
)


def embed_cte(name: str, source: str) -> tuple[str, str]:
    return (
        name,
        f"""SELECT s.seq_id, s.place, {zip_sql('t."values"', 'p."values"', '+')} AS "values"
            FROM {source} s JOIN wte t ON t.token = s.token JOIN wpe p ON p.place = s.place""",
    )


def norm_cte(name: str, source: str, gain: str, bias: str, block: int) -> tuple[str, str]:
    return (
        name,
        f"""SELECT seq_id, place,
                   list_transform(list_zip(c, g."values", h."values"),
                                  lambda t: t[1] / sqrt(list_dot_product(c, c) / {D} + 1e-5::DOUBLE) * t[2] + t[3]) AS "values"
            FROM (SELECT seq_id, place, list_transform("values", lambda t: t - m) AS c
                  FROM (SELECT *, list_sum("values") / {D} AS m FROM {source})) x,
                 (SELECT "values" FROM {gain} WHERE b = {block}) g, (SELECT "values" FROM {bias} WHERE b = {block}) h""",
    )


def linear_cte(name: str, source: str, weights: str, bias: str, block: int, wrap: str = "{}") -> tuple[str, str]:
    return (
        name,
        f"""SELECT seq_id, place, {wrap.format(zip_sql('o', 'h."values"', '+'))} AS "values"
            FROM (SELECT seq_id, place, list(list_dot_product(w."values", x."values") ORDER BY w.r) AS o
                  FROM {source} x, {weights} w WHERE w.b = {block} GROUP BY seq_id, place) x,
                 (SELECT "values" FROM {bias} WHERE b = {block}) h""",
    )


def add_cte(name: str, a: str, b: str) -> tuple[str, str]:
    return (
        name,
        f"""SELECT a.seq_id, a.place, {zip_sql('a."values"', 'b."values"', '+')} AS "values"
            FROM {a} a JOIN {b} b USING (seq_id, place)""",
    )


def block_ctes(p: str, source: str, block: int) -> Ctes:
    """One block with CTE prefix `p`: `{p}att` without residual, `{p}mha`, `{p}ffn`."""
    w = D // HEADS
    cut = lambda part: f'"values"[head * {w} + 1 + {part * D}:head * {w} + {w} + {part * D}]'
    return [
        norm_cte(f"{p}n1", source, "ln_1_g", "ln_1_b", block),
        linear_cte(f"{p}qkv", f"{p}n1", "c_attn_w", "c_attn_b", block),
        (
            f"{p}heads",
            f"SELECT seq_id, head, place, {cut(0)} AS q, {cut(1)} AS k, {cut(2)} AS v FROM {p}qkv, range({HEADS}) h(head)",
        ),
        (
            f"{p}scores",
            f"""SELECT a.seq_id, a.head, a.place AS x, b.place AS y,
                       list_dot_product(a.q, b.k) / sqrt({w}::DOUBLE)
                         + CASE WHEN b.place > a.place THEN -1e10::DOUBLE ELSE 0 END AS value
                FROM {p}heads a JOIN {p}heads b ON a.seq_id = b.seq_id AND a.head = b.head""",
        ),
        (
            f"{p}soft",
            f"""SELECT seq_id, head, x, y, e / sum(e) OVER (PARTITION BY seq_id, head, x) AS value
                FROM (SELECT *, CASE WHEN diff < -745.13 THEN 0 ELSE exp(diff) END AS e
                      FROM (SELECT *, value - max(value) OVER (PARTITION BY seq_id, head, x) AS diff FROM {p}scores))""",
        ),
        (
            f"{p}mix",
            f"""SELECT seq_id, x AS place, list(value ORDER BY head, i) AS "values"
                FROM (SELECT s.seq_id, s.head, s.x, i, sum(s.value * h.v[i]) AS value
                      FROM {p}soft s JOIN {p}heads h ON h.seq_id = s.seq_id AND h.head = s.head AND h.place = s.y,
                           range(1, {w + 1}) r(i)
                      GROUP BY ALL) GROUP BY seq_id, x""",
        ),
        linear_cte(f"{p}att", f"{p}mix", "c_proj_w", "c_proj_b", block),
        add_cte(f"{p}mha", f"{p}att", source),
        norm_cte(f"{p}n2", f"{p}mha", "ln_2_g", "ln_2_b", block),
        linear_cte(f"{p}up", f"{p}n2", "mlp_c_fc_w", "mlp_c_fc_b", block, gelu_sql("{}")),
        linear_cte(f"{p}down", f"{p}up", "mlp_c_proj_w", "mlp_c_proj_b", block),
        add_cte(f"{p}ffn", f"{p}down", f"{p}mha"),
    ]


def forward_ctes(p: str, source: str, n_block: int = BLOCKS) -> Ctes:
    """Token rows `source` to `{p}out`."""
    out, state = [embed_cte(f"{p}x", source)], f"{p}x"
    for block in range(n_block):
        out += block_ctes(f"{p}b{block}_", state, block)
        state = f"{p}b{block}_ffn"
    return [*out, norm_cte(f"{p}out", state, "ln_f_g", "ln_f_b", 0)]


BASE: Ctes = [*EMB, *model_ctes(), wpe_cte(PLACES), WTE, SEQ]
STAGES: Ctes = [*BASE, embed_cte("x", "seq"), *block_ctes("b0_", "x", 0), norm_cte("up_in", "x", "ln_2_g", "ln_2_b", 0)]
FFN_ONLY: Ctes = [
    *BASE,
    embed_cte("x", "seq"),
    norm_cte("n2", "x", "ln_2_g", "ln_2_b", 0),
    linear_cte("up", "n2", "mlp_c_fc_w", "mlp_c_fc_b", 0, gelu_sql("{}")),
    linear_cte("down", "up", "mlp_c_proj_w", "mlp_c_proj_b", 0),
    add_cte("ffn", "down", "x"),
]
FORWARD: Ctes = [*BASE, *forward_ctes("f_", "seq")]


def stage_query(source: str, ctes: Ctes = STAGES, keys: str = "seq_id, place") -> str:
    return with_(ctes, long(keys, source))


def score_query(source: str, where: str = "true", digits: int = 6) -> str:
    value = f"round(value, {digits}) + 0.0"
    return with_(STAGES, f"SELECT seq_id, head, x, y, {value} AS value FROM {source} WHERE {where}")


# --- Ranking and generation ------------------------------------------------------------------


def top_cte(name: str, source: str, n: int) -> tuple[str, str]:
    """The n best tokens of `(seq_id, values)`."""
    return (
        name,
        f"""SELECT seq_id, token, value
            FROM (SELECT l.seq_id, t.token, list_dot_product(l."values", t."values") AS value
                  FROM {source} l, wte t)
            QUALIFY row_number() OVER (PARTITION BY seq_id ORDER BY value DESC, token) <= {n}""",
    )


def heat_cte(name: str, source: str, temperatures: list[float]) -> tuple[str, str]:
    rows = ", ".join(f"({t}::DOUBLE)" for t in temperatures)
    w = "OVER (PARTITION BY seq_id, temperature)"
    return (
        name,
        f"""SELECT seq_id, token, value, temperature, e / sum(e) {w} AS softmax
            FROM (SELECT *, CASE WHEN diff < -745.13 THEN 0 ELSE exp(diff) END AS e
                  FROM (SELECT *, (value - max(value) {w}) / temperature AS diff
                        FROM {source}, (VALUES {rows}) v(temperature)))""",
    )


def interval_cte(name: str, source: str, order: str = "softmax, token ROWS UNBOUNDED PRECEDING") -> tuple[str, str]:
    return (
        name,
        f"""SELECT seq_id, token, softmax, high - softmax AS low, high
            FROM (SELECT *, sum(softmax) OVER (PARTITION BY seq_id ORDER BY {order}) AS high FROM {source})""",
    )


def draw_number(step: int) -> str:
    return f"((seq_id * 1103515245 + {step} * 12345 + 20231231) % 2147483648) / 2147483648.0::DOUBLE"


def draw_cte(name: str, source: str, step: int) -> tuple[str, str]:
    return (
        name,
        f"""SELECT seq_id, token FROM (SELECT *, {draw_number(step)} AS u, max(high) OVER (PARTITION BY seq_id) AS top FROM {source})
            QUALIFY row_number() OVER (PARTITION BY seq_id ORDER BY
              CASE WHEN high > u THEN 0 ELSE 1 END, CASE WHEN high > u THEN high ELSE -high END,
              CASE WHEN high > u THEN token ELSE -token END) = 1""",
    )


LOGITS: Ctes = [
    *FORWARD,
    ("last", 'SELECT seq_id, arg_max("values", place) AS "values" FROM f_out GROUP BY seq_id'),
    top_cte("logits", "last", 5),
]
LAST: Ctes = LOGITS[:-1]
HEAT: Ctes = [*LOGITS, heat_cte("heat", "logits", [0.5, 1, 2])]
INTERVALS: Ctes = [*LOGITS, heat_cte("hot", "logits", [2]), interval_cte("spans", "hot")]
SPANS = f"SELECT seq_id, token, {rounded('softmax')} AS softmax, {rounded('low')} AS low, {rounded('high')} AS high FROM spans"


def nearest_query() -> str:
    return with_(
        [*EMB, WTE, ("q", 'SELECT vec_id AS seq_id, v AS "values" FROM emb'), top_cte("t", "q", 5)],
        f"SELECT seq_id, token, {rounded('value')} AS value FROM t",
    )


def generation_ctes(start: str, steps: int, top_n: int, temperature: float, eos: int, n_block: int) -> Ctes:
    """States `s0` .. `s{steps}` `(seq_id, input, n, active)`. Without blocks only the last place
    matters and only it is embedded."""
    out: Ctes = [("s0", start)]
    for t in range(steps):
        p = f"g{t}_"
        rows = f"SELECT seq_id, unnest(input) AS token, generate_subscripts(input, 1) - 1 AS place FROM s{t} WHERE active"
        if n_block == 0:
            rows = f"SELECT seq_id, input[len(input)] AS token, len(input) - 1 AS place FROM s{t} WHERE active"
        out += [
            (f"{p}rows", rows),
            *forward_ctes(p, f"{p}rows", n_block),
            (
                f"{p}last",
                f'SELECT o.seq_id, o."values" FROM {p}out o JOIN s{t} s ON s.seq_id = o.seq_id AND o.place = len(s.input) - 1',
            ),
            top_cte(f"{p}top", f"{p}last", top_n),
            heat_cte(f"{p}hot", f"{p}top", [temperature]),
            interval_cte(f"{p}spans", f"{p}hot"),
            draw_cte(f"{p}draw", f"{p}spans", t),
            (
                f"s{t + 1}",
                f"""SELECT seq_id, CASE WHEN goes_on THEN list_append(input, token) ELSE input END AS input, n,
                           goes_on AS active
                    FROM (SELECT s.*, d.token, s.active AND coalesce(d.token <> {eos}, false) AS goes_on
                          FROM s{t} s LEFT JOIN {p}draw d ON d.seq_id = s.seq_id)""",
            ),
        ]
    return out


def generated_query(steps: int, top_n: int, eos: int) -> str:
    start = "SELECT seq_id, list(token ORDER BY place) AS input, count(*) AS n, true AS active FROM seq GROUP BY seq_id"
    ctes = [*BASE, *generation_ctes(start, steps, top_n, 2, eos, BLOCKS)]
    return with_(
        ctes,
        f"""SELECT seq_id, generate_subscripts(input, 1) - 1 AS place, unnest(input) AS token,
                   len(input) = n + {steps} AS complete FROM s{steps}""",
    )


def options_query(steps: int, most: int) -> str:
    """Generation with settings per row: at most `steps` tokens and `most` candidates."""
    ctes: Ctes = [
        *BASE,
        (
            "s0",
            f"""SELECT seq_id, list(token ORDER BY place) AS input, count(*) AS n, true AS active,
                       1 + seq_id % 4 AS threshold, 1 + seq_id % 3 AS top_n,
                       ([0.5::DOUBLE, 1, 2])[1 + seq_id % 3] AS temperature,
                       CASE WHEN seq_id % 2 = 0 THEN {SAMPLED_EOS} ELSE -1 END AS eos
                FROM seq GROUP BY seq_id""",
        ),
    ]
    for t in range(steps):
        p = f"o{t}_"
        rows = f"SELECT seq_id, unnest(input) AS token, generate_subscripts(input, 1) - 1 AS place FROM s{t} WHERE active"
        w = "OVER (PARTITION BY seq_id)"
        ctes += [
            (f"{p}rows", rows),
            *forward_ctes(p, f"{p}rows"),
            (
                f"{p}last",
                f'SELECT o.seq_id, o."values" FROM {p}out o JOIN s{t} s ON s.seq_id = o.seq_id AND o.place = len(s.input) - 1',
            ),
            top_cte(f"{p}best", f"{p}last", most),
            (
                f"{p}top",
                f"""SELECT b.*, s.temperature FROM {p}best b JOIN s{t} s ON s.seq_id = b.seq_id
                    QUALIFY row_number() OVER (PARTITION BY b.seq_id ORDER BY value DESC, token) <= any_value(s.top_n) OVER (PARTITION BY b.seq_id)""",
            ),
            (
                f"{p}hot",
                f"""SELECT seq_id, token, e / sum(e) {w} AS softmax
                    FROM (SELECT *, CASE WHEN diff < -745.13 THEN 0 ELSE exp(diff) END AS e
                          FROM (SELECT *, (value - max(value) {w}) / temperature AS diff FROM {p}top))""",
            ),
            interval_cte(f"{p}spans", f"{p}hot"),
            draw_cte(f"{p}draw", f"{p}spans", t),
            (
                f"s{t + 1}",
                f"""SELECT seq_id, CASE WHEN goes_on THEN list_append(input, token) ELSE input END AS input, n,
                           goes_on AND len(input) + 1 < n + threshold AS active, threshold, top_n, temperature, eos
                    FROM (SELECT s.*, d.token, s.active AND coalesce(d.token <> s.eos, false) AS goes_on
                          FROM s{t} s LEFT JOIN {p}draw d ON d.seq_id = s.seq_id)""",
            ),
        ]
    return with_(
        ctes,
        f"""SELECT seq_id, generate_subscripts(input, 1) - 1 AS place, unnest(input) AS token,
                   len(input) = n + threshold AS complete FROM s{steps}""",
    )


def load_query() -> str:
    parts = [
        f"""SELECT '{name}' AS table_name, b::BIGINT AS block, count(*) AS n_rows, round(sum(list_sum("values")), 6) + 0.0 AS total
            FROM {name} GROUP BY b"""
        for name in MODEL_TABLES
    ]
    parts += [
        f"""SELECT '{name}', 0, count(*), round(sum(list_sum("values")), 6) + 0.0 FROM {name}""" for name in ("wte", "wpe")
    ]
    return with_(BASE, "\nUNION ALL\n".join(parts))


RUNNING_SUM = "SELECT doc_id, (sum(n_chars) OVER (ORDER BY n_chars))::BIGINT AS running FROM documents"
INTERVAL_JOIN = """WITH sums AS (
  SELECT doc_id, n_chars, (sum(n_chars) OVER (ORDER BY n_chars, doc_id ROWS UNBOUNDED PRECEDING))::BIGINT AS high FROM documents
), spans AS (SELECT doc_id, high - n_chars AS low, high FROM sums),
draws AS (
  SELECT conv_id, turn,
         (((conv_id * 1000 + turn) * 1103515245 + 12345) % 1048573) * (SELECT max(high) FROM spans) // 1048573 AS u
  FROM conversations
)
SELECT conv_id, turn, doc_id, u, low, high FROM draws JOIN spans ON u >= low AND u < high"""


def prompts_query() -> str:
    start = """SELECT conv_id * 100000 + turn AS seq_id, list(token ORDER BY part_position, position) AS input,
                      count(*) AS n, true AS active FROM occ JOIN tok USING (part) GROUP BY ALL"""
    start = start.replace("GROUP BY ALL", "GROUP BY conv_id, turn")
    value = formula(TABLE_CODE_WTE, "0", "r", D, 0.0, 1.0)
    ctes = [
        *text_ctes("conversations", "conv_id, turn"),
        *model_ctes(),
        wpe_cte(TEXT_PLACES),
        ("wte", f'SELECT r AS token, {value} AS "values" FROM range((SELECT count(*) FROM vocab)) y(r)'),
        *generation_ctes(start, PROMPT_STEPS, 1, 2, -1, 0),
        (
            "decoded",
            f"""SELECT seq_id, string_agg(h, '' ORDER BY i) AS h
                FROM (SELECT seq_id, unnest(input) AS token, generate_subscripts(input, 1) AS i
                      FROM s{PROMPT_STEPS} WHERE len(input) = n + {PROMPT_STEPS}) JOIN vocab_hex USING (token) GROUP BY seq_id""",
        ),
    ]
    return with_(
        ctes,
        """SELECT p.conv_id * 100000 + p.turn AS seq_id, d.h AS bytes_hex, TRY(decode(unhex(d.h))) AS response
           FROM conversations p LEFT JOIN decoded d ON d.seq_id = p.conv_id * 100000 + p.turn""",
        recursive=True,
    )


def preview(values: str) -> str:
    cells = f"list_transform({values}[1:3], lambda t: printf('%+.3f', t))"
    return f"array_to_string({cells}, ' ') || ' …'"


def report_query() -> str:
    return with_(
        STAGES,
        f"""SELECT h.seq_id, h.place, {preview('h.q')} AS q, {preview('h.k')} AS k, {preview('h.v')} AS v, matrix,
                   {preview('m."values"')} AS attention
            FROM b0_heads h
            JOIN (SELECT seq_id, x, string_agg(CASE WHEN value > 0 THEN printf(' %.2f', value) ELSE '    0' END, ' ' ORDER BY y) AS matrix
                  FROM b0_soft WHERE head = 0 GROUP BY seq_id, x) g ON g.seq_id = h.seq_id AND g.x = h.place
            JOIN b0_mix m ON m.seq_id = h.seq_id AND m.place = h.place
            WHERE h.head = 0""",
    )


def comparison_query() -> str:
    cell = lambda t: f"printf(' %.2f', max(CASE WHEN temperature = {t} THEN softmax END))"
    return with_(
        [*text_ctes()[:7], *HEAT],
        f"""SELECT seq_id, token, cluster, printf('%+07.3f', value) AS score, {cell(0.5)} AS temperature_0_5,
                   {cell(1)} AS temperature_1, {cell(2)} AS temperature_2
            FROM heat JOIN vocab USING (token) GROUP BY seq_id, token, cluster, value""",
        recursive=True,
    )


# --- Ingest ----------------------------------------------------------------------------------


def checks_query() -> str:
    null = lambda t, c, key: (
        f"SELECT '{t}' AS table_name, 'null:{c}' AS rule, {key} AS key, count(*) AS n FROM {t} WHERE {c} IS NULL GROUP BY {key}"
    )
    dup = lambda t, keys, key: (
        f"SELECT '{t}', 'duplicate', {key}, count(*) FROM {t} GROUP BY {keys} HAVING count(*) > 1"
    )
    line, doc = "l_orderkey || '|' || l_linenumber", "lang || '|' || n_chars"
    order, vec = "o_custkey::VARCHAR", "vec_id::VARCHAR"
    bad = lambda rule, test: (
        f"SELECT 'embeddings', '{rule}:embedding', {vec}, count(*) FROM embeddings WHERE {test} GROUP BY {vec}"
    )
    return "\nUNION ALL\n".join(
        [
            null("lineitem", "l_shipdate", line),
            null("lineitem", "l_quantity", line),
            dup("lineitem", "l_orderkey, l_linenumber", line),
            null("orders", "o_orderdate", order),
            dup("orders", "o_custkey", order),
            null("documents", "text", doc),
            dup("documents", "lang, n_chars", doc),
            null("embeddings", "embedding", vec),
            bad("width", f"len(embedding) <> {D}"),
            bad("nan", "list_bool_or(list_transform(embedding, lambda t: isnan(t)))"),
            dup("embeddings", "vec_id", vec),
        ]
    )


def statements() -> dict[str, str]:
    emb = lambda select: with_(EMB, select)
    label_sum = 'SELECT label, i, sum(value) AS s, avg(value) AS m FROM (SELECT label, unnest(v) AS value, generate_subscripts(v, 1) - 1 AS i FROM emb) GROUP BY label, i'
    embedded = stage_query("x", [*BASE, embed_cte("x", "seq")])
    linear = stage_query("b0_qkv")
    feed_forward = stage_query("ffn", FFN_ONLY)
    block = stage_query("b0_ffn")
    transform = stage_query("f_b1_ffn", FORWARD)
    encoded = stage_query("f_out", FORWARD)
    return {
        "explode_dictionary": """SELECT event_id, json_extract_string(props, '$.' || k) AS value, k AS key
            FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""",
        "transpose_row_vectors": emb(
            f"""SELECT vec_id // 10 AS block, j AS place, vec_id % 10 AS i, {rounded('value')} AS value
                FROM (SELECT vec_id, unnest(v) AS value, generate_subscripts(v, 1) - 1 AS j FROM emb)"""
        ),
        "transpose_long": emb(
            f"""SELECT generate_subscripts(v, 1) - 1 AS place, vec_id AS row_key, {rounded('unnest(v)')} AS value FROM emb"""
        ),
        "validate_table": checks_query(),
        "load_parameters": load_query(),
        "pretokenize": with_([("occ", occurrences("documents", "doc_id"))], "SELECT doc_id, part_position, part FROM occ"),
        "byte_symbols": with_(
            [("enc", ENCODER), ("occ", occurrences("documents", "doc_id")), ("parts", "SELECT DISTINCT part FROM occ"),
             ("syms", symbols("parts"))],
            "SELECT part, position, symbol AS character FROM syms",
        ),
        "bpe_merge": text_query("SELECT part, position, cluster FROM fin"),
        "extend_part_dictionary": with_(
            text_ctes("conversations", "conv_id, turn", "conversations"), "SELECT part, position, cluster FROM fin",
            recursive=True,
        ),
        "bpe_trace": text_query(
            """SELECT part, step, token, v.cluster AS combined, symbols
               FROM (SELECT part, step, max(token) AS token, string_agg(symbol, ' ' ORDER BY position) AS symbols
                     FROM bpe GROUP BY part, step) LEFT JOIN vocab v USING (token)"""
        ),
        "tokenize": text_query(
            "SELECT conv_id, turn, part_position, position, token, cluster FROM occ JOIN tok USING (part)",
            "conversations", "conv_id, turn",
        ),
        "token_sequences": sequence_query("conversations", "conv_id, turn"),
        "text_sequences": sequence_query("documents", "doc_id"),
        "token_stats_by_lang": stats_query("documents", "doc_id", "lang"),
        "token_stats_by_role": stats_query("conversations", "conv_id, turn", "role"),
        "top_tokens_by_source": text_query(
            """SELECT source, row_number() OVER (PARTITION BY source ORDER BY n DESC, token) AS rank, token, n
               FROM (SELECT source, token, count(*) AS n FROM occ JOIN tok USING (part) GROUP BY source, token)
               QUALIFY rank <= 10""",
            "documents", "doc_id, source",
        ),
        "detokenize": text_query(DECODED),
        "decode_sequences": text_query(DECODED),
        "roundtrip_check": text_query(
            f"""SELECT lang, count(*) AS n_texts, count(*) FILTER (coalesce(r.response, '') <> d.text) AS n_different
                FROM documents d LEFT JOIN ({DECODED}) r ON r.doc_id = d.doc_id GROUP BY lang"""
        ),
        "vec_add": vector_query(zip_sql("v", "list_reverse(v)", "+")),
        "vec_mul": vector_query(zip_sql("v", "list_reverse(v)", "*")),
        "vec_scale": vector_query("list_transform(v, lambda t: t * 0.125::DOUBLE)"),
        "vec_slice": vector_query("v[17:32]"),
        "vec_preview": vector_query("v[1:5]"),
        "gelu": vector_query(gelu_sql("v")),
        "inner_product": emb(
            f"""SELECT vec_id, {rounded('list_dot_product(v, m)')} AS value
                FROM emb JOIN (SELECT label, list(m ORDER BY i) AS m FROM ({label_sum}) GROUP BY label) USING (label)"""
        ),
        "vec_sum": emb(f"SELECT label::BIGINT AS label, i, {rounded('s')} AS value FROM ({label_sum})"),
        "centroids": emb(f"SELECT label::BIGINT AS label, i, {rounded('m')} AS value FROM ({label_sum})"),
        "unnest_vector": emb(
            f"SELECT vec_id, generate_subscripts(v, 1) AS ordinality, {rounded('unnest(v)')} AS value FROM emb"
        ),
        "renest_vector": emb(long("vec_id", "emb", "v")),
        "embed": embedded,
        "embed_dropped": """SELECT 'unknown token' AS reason, count(*) FILTER (token NOT IN (SELECT vec_id FROM embeddings)) AS n
            FROM (SELECT vec_id * 3 AS token FROM embeddings)
            UNION ALL SELECT 'unknown place', count(*) FILTER (vec_id % 100 >= 64) FROM embeddings""",
        "layer_norm": stage_query("b0_n1"),
        "linear": linear,
        "linear_packed": linear,
        "linear_shuffle": linear,
        "linear_blocks": linear,
        "split_heads": with_(
            STAGES,
            f"""SELECT seq_id, head, place, i, {rounded('q')} AS q, {rounded('k')} AS k, {rounded('v')} AS v
                FROM (SELECT seq_id, head, place, unnest(q) AS q, unnest(k) AS k, unnest(v) AS v,
                             generate_subscripts(q, 1) - 1 AS i FROM b0_heads)""",
        ),
        "attention_scores": score_query("b0_scores", "y <= x"),
        "attention_scores_full": score_query("b0_scores", digits=3),
        "attention_softmax": score_query("b0_soft", "y <= x"),
        "attention_softmax_full": score_query("b0_soft"),
        "attention_output": stage_query("b0_mix"),
        "attention_merged": stage_query("b0_mix"),
        "multi_head_attention": stage_query("b0_mha"),
        "multi_head_attention_relational": stage_query("b0_mha"),
        "multi_head_attention_tiled": stage_query("b0_mha"),
        "multi_head_attention_no_residual": stage_query("b0_att"),
        "feed_forward": feed_forward,
        "feed_forward_relational": feed_forward,
        "transformer_block": block,
        "transformer_block_relational": block,
        "transform": transform,
        "transform_relational": transform,
        "encode_sequences": encoded,
        "encode_sequences_relational": encoded,
        "attention_matrix_report": report_query(),
        "last_place": stage_query("last", LAST, "seq_id"),
        "top_n_by_inner_product": nearest_query(),
        "top_n_by_inner_product_tiled": nearest_query(),
        "next_token_logits": with_(LOGITS, f"SELECT seq_id, token, {rounded('value')} AS value FROM logits"),
        "temperature_softmax": with_(
            HEAT,
            f"SELECT seq_id, token, temperature, {rounded('value')} AS value, {rounded('softmax')} AS softmax FROM heat",
        ),
        "temperature_comparison": comparison_query(),
        "cumulative_intervals": with_(INTERVALS, SPANS),
        "cumulative_intervals_range": with_(
            [*INTERVALS[:-1], interval_cte("spans", "hot", "softmax")], SPANS
        ),
        "weighted_sample": with_([*INTERVALS, draw_cte("drawn", "spans", 0)], "SELECT seq_id, token FROM drawn"),
        "weighted_sample_reference": with_(
            [*INTERVALS[:-1], interval_cte("spans", "hot", "softmax")],
            f"SELECT seq_id, token FROM (SELECT *, {draw_number(0)} AS u FROM spans) WHERE u >= low AND u < high",
        ),
        "generate": generated_query(GREEDY_STEPS, 1, -1),
        "generate_relational": generated_query(GREEDY_STEPS, 1, -1),
        "generate_sampled": generated_query(SAMPLED_STEPS, 3, SAMPLED_EOS),
        "generate_cached": generated_query(SAMPLED_STEPS, 3, SAMPLED_EOS),
        "generate_options": options_query(4, 3),
        "generate_options_cached": options_query(4, 3),
        "running_sum": RUNNING_SUM,
        "interval_join": INTERVAL_JOIN,
        "complete_prompts": prompts_query(),
    }

"""The registered queries and the SQL that checks those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ..plans.registry import query
from . import mixing
from .chat_format import CLOSE, CONTROL, OPEN, ROLE_NAMES, chat_digests, format_chats
from .common import WORD, ascii_lower_sql, table
from .exact_dedup import exact_groups
from .extraction import extract_text
from .merkle import merkle_manifest
from .near_dedup import near_duplicates
from .ngram_join import ngram_join
from .packing import pack
from .repair import repair_conversations
from .token_count import count_tokens
from .topk import top_k
from .toxicity import score_toxicity
from .url_filter import BLOCKED_HOSTS, judge_urls

#: The url rules of the query, (verdict, host, path).
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Fixed value: what both turns of the added conversation say.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query(
    """WITH v AS (
         SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
         FROM embeddings
         WHERE embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
       s AS (
         SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
         FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
       r AS (
         SELECT query_id,
                row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
                vec_id, score FROM s)
       SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""
)
def op1_topk(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@query()
def op2_pack(spark, sf_dir):
    packed = pack(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        carry={"ids_crc32": F.crc32("ids")},
    )
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query()
def op3_extract(spark, sf_dir):
    texts = extract_text(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def _raked_sql(rounds: int) -> str:
    """The raking and the inclusion probabilities of ``mixing``, round by round."""
    topic = " ".join(
        f"WHEN contains(text, '{mark}') THEN '{name}'" for name, mark in mixing.TOPIC_MARKS
    )
    parts = [
        f"""WITH d AS (
          SELECT doc_id, coalesce(source, '(null)') AS source, coalesce(lang, '(null)') AS lang,
                 coalesce(text, '') AS text FROM documents),
        m AS (
          SELECT doc_id, source, lang, CASE {topic} ELSE 'prose' END AS topic,
                 len(regexp_extract_all(text, '{WORD}'))::BIGINT AS n_tokens FROM d),
        c AS (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens FROM m
              GROUP BY ALL HAVING sum(n_tokens) > 0),
        w0 AS (SELECT *, tokens::DOUBLE AS weight, sum(tokens) OVER () AS total FROM c)"""
    ]
    for margin, power in mixing.TARGET_POWERS.items():
        parts.append(
            f"""g_{margin} AS (
              SELECT {margin}, p / sum(p) OVER () AS goal FROM (
                SELECT {margin}, pow(sum(tokens) / max(total), {power}) AS p FROM w0 GROUP BY 1))"""
        )
    last = "w0"
    for turn in range(rounds):
        for margin in mixing.MARGINS:
            name = f"w{turn}_{margin}"
            parts.append(
                f"""{name} AS (
                  SELECT source, lang, topic, tokens, total,
                         weight * goal * total / sum(weight) OVER (PARTITION BY {margin}) AS weight
                  FROM {last} JOIN g_{margin} USING ({margin}))"""
            )
            last = name
    parts.append(
        f"""f AS (SELECT source, lang, topic, tokens, total, weight / tokens AS weight FROM {last}),
        o AS (SELECT *, row_number() OVER o AS place,
                coalesce(sum(tokens) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b,
                sum(tokens * weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r
              FROM f WINDOW o AS (ORDER BY weight DESC, source, lang, topic)),
        s AS (SELECT *, ({mixing.KEEP_SHARE} * total - b) / r AS scale FROM o),
        k AS (SELECT arg_min(scale, place) AS scale FROM s WHERE scale * weight <= 1),
        p AS (SELECT source, lang, topic, weight,
                     least(1.0, (SELECT scale FROM k) * weight) AS probability FROM f)
        SELECT doc_id, m.source, m.lang, m.topic, n_tokens, round(coalesce(weight, 0), 6) AS weight,
               round(coalesce(probability, 0), 6) AS probability,
               ('0x' || substr(md5('{mixing.SEED}:' || doc_id), 1, 13))::BIGINT / pow(2, 52)
                 < coalesce(probability, 0) AS kept
        FROM m LEFT JOIN p USING (source, lang, topic)"""
    )
    return ",\n".join(parts)


@query(_raked_sql(mixing.ROUNDS))
def op4_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query()
def op5_count(spark, sf_dir):
    return count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), 4096
    )


def _escaped_sql(text: str) -> str:
    escaped = f"replace({text}, '\\', '\\\\')"
    for control in CONTROL:
        escaped = f"replace({escaped}, '{control}', '{control[0]}\\{control[1:]}')"
    return escaped


@query(
    f"""WITH t AS (
         SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
         UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}'
         UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}')
       SELECT conv_id, count(*) AS n_turns,
              sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
              sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
              sha256(coalesce(string_agg(text, '' ORDER BY turn)
                              FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
              sum({len(OPEN) + len(CLOSE) + 2} + length({_escaped_sql('role')})
                  + length({_escaped_sql('text')}))::BIGINT AS formatted_chars
       FROM t GROUP BY conv_id"""
)
def op6_chat(spark, sf_dir):
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sender = F.when(role == "user", "human").when(role == "assistant", "gpt").otherwise(role)
    said = lambda **fields: F.struct(*[c.alias(n) for n, c in fields.items()])
    plain, content = said(role=role, text=text), said(role=role, content=text)
    listed = said(messages=F.array(content))
    named = said(conversations=F.array(F.struct(sender.alias("from"), text.alias("value"))))
    # four layouts side by side; roles that the last one would rename keep to the first
    kind = F.crc32(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))) % 4
    record = (
        F.when(kind == 1, F.to_json(content))
        .when(kind == 2, F.to_json(listed))
        .when((kind == 3) & ~role.isin(*ROLE_NAMES), F.to_json(named))
        .otherwise(F.to_json(plain))
    )
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), record.alias("record")
    )
    pair = F.to_json(F.struct(F.lit(CONTROL_TEXT).alias("prompt"), F.lit(CONTROL_TEXT).alias("response")))
    added = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), pair.alias("record")
    )
    return chat_digests(format_chats(rows.unionByName(added)))


@query()
def op7_toxicity(spark, sf_dir):
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _linked_sql(width: int, columns: str) -> str:
    """Components of texts whose shingle sets have a similarity of 0.8, all pairs compared."""
    return f"""WITH RECURSIVE w AS (
         SELECT doc_id, regexp_extract_all({ascii_lower_sql("coalesce(text, '')")}, '{WORD}') AS w
         FROM documents),
       s AS (
         SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN
                [array_to_string(w, ' ')] ELSE
                list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i+{width - 1}], ' ')) END) AS s
         FROM w),
       x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
       p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS m, any_value(b.n) AS n
             FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
       l AS (SELECT a, b FROM p WHERE 100 * c >= 80 * (m + n - c)),
       e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
       r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
       k AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
       SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id{columns}
       FROM s JOIN k USING (doc_id)"""


@query(_linked_sql(4, ", doc_id = component_id AS kept"))
def op8_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


_RULES_SQL = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
_HOSTS_SQL = ", ".join(f"('{h}')" for h in BLOCKED_HOSTS)


@query(
    f"""WITH u AS (
         SELECT page_id, CASE WHEN instr(url, '://') > 0
                              THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
       h AS (
         SELECT page_id, {ascii_lower_sql("regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1)")} AS host,
                regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
       rules AS (SELECT * FROM (VALUES {_RULES_SQL}) AS t(verdict, h, p)),
       hosts AS (SELECT * FROM (VALUES {_HOSTS_SQL}) AS t(h)),
       m AS (
         SELECT page_id, arg_max(r.h || r.p, length(r.h || r.p)) AS rule,
                arg_max(r.verdict, length(r.h || r.p)) AS verdict
         FROM h JOIN rules r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p)
         GROUP BY page_id)
       SELECT page_id, host, path, rule, coalesce(m.verdict, CASE WHEN EXISTS (
                SELECT 1 FROM hosts b WHERE host = b.h OR ends_with(host, '.' || b.h))
                THEN 'block' ELSE 'allow' END) AS verdict
       FROM h LEFT JOIN m USING (page_id)"""
)
def op9_urls(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES, BLOCKED_HOSTS)


@query(
    f"""WITH n AS (SELECT doc_id, sha256({ascii_lower_sql("coalesce(text, '')")}) AS s FROM documents)
       SELECT doc_id, max(doc_id) OVER (PARTITION BY s) AS keep_id,
              count(*) OVER (PARTITION BY s) AS group_size,
              doc_id = max(doc_id) OVER (PARTITION BY s) AS kept, s AS text_sha256 FROM n"""
)
def op10_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))


@query(_linked_sql(5, ""))
def op11_ngram_join(spark, sf_dir):
    return ngram_join(table(spark, sf_dir, "documents"), width=5, percent=80)


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    bits = "list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), xor(acc, x))"
    letters = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce({letters}, lambda acc, x: {bits}, 4294967295::BIGINT), 4294967295)"


#: Levels of the trees in the SQL below: up to 2 ** 24 leaves a language, 2 ** 8 languages.
LEAF_LEVELS, HEAD_LEVELS = 24, 8


def _tree_sql(name: str, start: str, levels: int) -> str:
    """All nodes (tree, k, i, d, n) of the trees whose leaves are (tree, i, d); n a level's nodes."""
    parts = [f"{name}0 AS (SELECT tree, i, d, count(*) OVER (PARTITION BY tree) AS n FROM {start})"]
    for k in range(levels):
        parts.append(
            f"""{name}{k + 1} AS (
              SELECT tree, i, CASE WHEN m = 1 THEN d ELSE sha256(joined) END AS d,
                     count(*) OVER (PARTITION BY tree) AS n
              FROM (SELECT tree, i // 2 AS i, any_value(d) AS d, any_value(n) AS m,
                           string_agg(d, '' ORDER BY i) AS joined FROM {name}{k} GROUP BY 1, 2))"""
        )
    union = " UNION ALL ".join(f"SELECT tree, {k} AS k, i, d, n FROM {name}{k}" for k in range(levels + 1))
    return ",\n".join([*parts, f"{name} AS MATERIALIZED ({union})"])


def _fold_sql(name: str, start: str, tree: str) -> str:
    """Climbs (row, tree, i, d, proof) of ``start`` to the roots of ``tree``."""
    return f"""{name}(row, tree, i, k, d, proof) AS (
         SELECT row, tree, i, 0, d, proof FROM {start}
         UNION ALL
         SELECT f.row, f.tree, f.i // 2, f.k + 1,
                sha256(CASE WHEN s.d IS NULL THEN f.d WHEN f.i % 2 = 0 THEN f.d || s.d
                            ELSE s.d || f.d END), f.proof || coalesce(s.d, '')
         FROM {name} f JOIN {tree} o ON o.tree = f.tree AND o.k = f.k AND o.i = f.i AND o.n > 1
         LEFT JOIN {tree} s ON s.tree = f.tree AND s.k = f.k AND s.i = xor(f.i, 1))"""


def _manifest_sql() -> str:
    def leaf(n_chars: str) -> str:
        fields = ["doc_id", "source", "lang", n_chars, "text"]
        texts = [f"coalesce(strlen(({f})::VARCHAR) || ':' || ({f})::VARCHAR, '-')" for f in fields]
        return f"sha256({' || '.join(texts)})"

    ends = lambda name: f"SELECT * FROM {name} QUALIFY k = max(k) OVER (PARTITION BY row)"
    return f"""WITH RECURSIVE leaves AS (
         SELECT row_number() OVER () AS row, doc_id, coalesce('=' || lang, '-') AS tree, {leaf("n_chars")} AS d,
                CASE WHEN {_crc32_sql("doc_id::VARCHAR")} % 7 = 0 THEN {leaf("n_chars + 1")}
                     ELSE {leaf("n_chars")} END AS other FROM documents),
       numbered AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS i
                    FROM leaves),
       {_tree_sql("n", "numbered", LEAF_LEVELS)},
       subroots AS (SELECT tree AS lang, d, row_number() OVER (ORDER BY tree) - 1 AS i
                    FROM n{LEAF_LEVELS}),
       heads AS (SELECT '' AS tree, i, d FROM subroots),
       {_tree_sql("h", "heads", HEAD_LEVELS)},
       sound AS (SELECT row, tree, i, d, '' AS proof FROM numbered),
       bad AS (SELECT row, tree, i, other AS d, '' AS proof FROM numbered),
       {_fold_sql("f", "sound", "n")},
       {_fold_sql("g", "bad", "n")},
       f_end AS ({ends("f")}), g_end AS ({ends("g")}),
       f_up AS (SELECT row, '' AS tree, s.i, f.d, proof FROM f_end f JOIN subroots s ON f.tree = s.lang),
       g_up AS (SELECT row, '' AS tree, s.i, g.d, proof FROM g_end g JOIN subroots s ON g.tree = s.lang),
       {_fold_sql("ff", "f_up", "h")},
       {_fold_sql("gg", "g_up", "h")},
       ff_end AS ({ends("ff")}), gg_end AS ({ends("gg")})
       SELECT n.doc_id, n.d AS leaf, s.d AS subroot, r.d AS root, sha256(f.proof) AS proof_sha256,
              g.d AS folded_root, g.d = r.d AS verified
       FROM numbered n JOIN subroots s ON n.tree = s.lang JOIN ff_end f ON f.row = n.row
       JOIN gg_end g ON g.row = n.row CROSS JOIN h{HEAD_LEVELS} r"""


@query(_manifest_sql())
def op12_manifest(spark, sf_dir):
    found = merkle_manifest(
        table(spark, sf_dir, "documents"),
        tampered={"n_chars": F.col("n_chars") + 1},
        where=F.crc32(F.col("doc_id").cast("string")) % 7 == 0,
    )
    return found.drop("proof")


def _repair_sql() -> str:
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    never = 1_000_000_000

    def after(state: str, cost: str, edit: str, item: str = "") -> str:
        item = f" || chr(10) || {item}" if item else ""
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'r': {state}.r{item}}}"

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    to_user = ", ".join(after(s, "5", "I", "'user:'") for s in ("s0", "s1", "s3"))
    closed = lambda source: f"""SELECT *, {least("s3", after("y2", "5", "I", "'assistant:'"))} AS y3
                 FROM (SELECT *, {least("s2", to_user)} AS y2 FROM {source})"""  # noqa: E731
    cut = "CASE WHEN fault = 1 THEN 5 ELSE 0 END"
    keep = lambda state, letter: after(
        state, f"CASE WHEN fault > 1 OR l <> '{letter}' THEN {never} ELSE {cut} END", "K", "role || ':' || text"
    )
    rerole = lambda state, role: after(
        state, f"1 + CASE WHEN fault > 1 THEN {never} ELSE {cut} END", "R", f"'{role}:' || text"
    )
    stepped = f"""SELECT conv, i + 1 AS i, {after("s0", "2", "D")} AS s0,
           {least(after("s1", "2", "D"), keep("s0", "s"))} AS s1,
           {least(after("y2", "2", "D"), *[f(s, x) for s in ("s0", "s1", "y3") for f, x in ((keep, "u"), (rerole, "user"))])} AS s2,
           {least(after("y3", "2", "D"), keep("y2", "a"), rerole("y2", "assistant"))} AS s3"""
    joined = "(SELECT d.*, f.role, f.text, f.fault, f.l FROM dp d JOIN f ON f.conv = d.conv AND f.i = d.i + 1)"
    none = f"{{'c': {never}, 'a': '', 'r': ''}}"
    return f"""WITH RECURSIVE ids AS (
         SELECT conv_id, dense_rank() OVER (ORDER BY conv_id) AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
       base AS (
         SELECT conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                {_crc32_sql("coalesce(c.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k
         FROM conversations c JOIN ids ON ids.conv_id IS NOT DISTINCT FROM c.conv_id),
       damaged AS (
         SELECT conv, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
                CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(CASE k WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM base),
       numbered AS (
         SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv, role, text
                  ORDER BY turn NULLS FIRST, copy) AS seen, rtrim(text, {blanks}) AS t,
                substr(role, 1, 1) AS l, lag(substr(role, 1, 1)) OVER w AS b
         FROM damaged WINDOW w AS (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
       f AS (SELECT *, CASE WHEN t = '' THEN 2 WHEN seen > 1 THEN 3
                            WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault FROM numbered),
       dp(conv, i, s0, s1, s2, s3) AS (
         SELECT conv, 0::BIGINT, {{'c': 0, 'a': '', 'r': ''}}, {none}, {none}, {none} FROM ids
         UNION ALL {stepped} FROM ({closed(joined)})),
       last AS (SELECT * FROM dp QUALIFY i = max(i) OVER (PARTITION BY conv)),
       best AS (SELECT conv, {least("s0", "y3")} AS e FROM ({closed("last")})),
       facts AS (
         SELECT conv, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
                count(*) FILTER (WHERE fault = 2) AS blank, count(*) FILTER (WHERE fault = 3) AS duplicate,
                count(*) FILTER (WHERE fault = 1) AS truncated,
                count(*) FILTER (WHERE b IS NOT NULL AND b || l NOT IN ('su', 'ua', 'au')) AS illegal
         FROM f GROUP BY conv)
       SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
              coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
              coalesce(illegal, 0) AS illegal, e.c::BIGINT AS cost, e.a AS audit,
              sha256(substr(e.r, 2)) AS repaired_sha256
       FROM ids JOIN best USING (conv) LEFT JOIN facts USING (conv)"""


def damaged(rows):
    """Rows (conv_id, turn, role, text) as the query of op13 damages them."""
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    kind = F.crc32(key) % 20
    text = F.coalesce("text", F.lit(" "))
    hurt = rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "")
        .when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    ).filter("copies > 0")
    repeated = hurt.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
    return repeated.drop("copies", "copy")


@query(_repair_sql())
def op13_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return repair_conversations(damaged(rows), rows)

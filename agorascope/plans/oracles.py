"""DuckDB SQL with the same result for the registered queries. Iterative fits have none."""

from __future__ import annotations

from agorascope import fixed
from agorascope.plans.fixtures import EMOJI, IDIOMS, LEXICON, PHRASE_RULES, RULES, SOCIAL, STOP_WORDS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _listed(values) -> str:
    return ", ".join(_text(v) for v in values)


WS = _text(fixed.WHITESPACE)
PUNCT = _text(fixed.PUNCTUATION)


def _strip(x: str) -> str:
    return f"trim({x}, {WS})"


def _account(x: str) -> str:
    name = f"nullif({_strip(x)}, '')"
    return f"CASE WHEN lower({name}) NOT IN ({_listed(fixed.NO_ACCOUNT)}) THEN {name} END"


def _clean(x: str) -> str:
    x = f"regexp_replace(lower({x}), '{fixed.URL_PATTERN}', '', 'g')"
    x = f"regexp_replace({x}, '{fixed.NOT_ALNUM_PATTERN}', ' ', 'g')"
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def _short_label(x: str, inclusive: bool, labels=fixed.SHORT_LABELS) -> str:
    eq = "=" if inclusive else ""
    neg, neu, pos = labels
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} >{eq} 0.05 THEN '{pos}' "
        f"WHEN {x} <{eq} -0.05 THEN '{neg}' ELSE '{neu}' END"
    )


# --- shared tables ---

SOCIAL_CTE = f"social AS ({SOCIAL.format(events='events')})"

LEXICON_CTE = "lexicon(token, valence) AS (VALUES " + ", ".join(
    f"({_text(t)}, CAST({v} AS DOUBLE))" for t, v in LEXICON
) + ")"

MESSAGES_CTE = f"""{SOCIAL_CTE},
messages AS (
  SELECT topic, kafka_ts, topic = 'posts' AS is_post, id, fullname, subreddit, author, score, parent_id, body,
         strftime(kafka_ts, '%Y-%m-%dT%H:%M:%SZ') AS ingested_at,
         epoch_us(event_ts) // 1000000 + CASE WHEN topic = 'posts' THEN 0.0 ELSE 0.5 END AS seconds
  FROM social
)"""

EDGES_CTE = f"""{SOCIAL_CTE},
comments AS (
  SELECT *, {_account("author")} AS src FROM social WHERE topic = 'comments' AND parent_id IS NOT NULL
),
parents AS (
  SELECT fullname, author FROM (
    SELECT fullname, author,
           row_number() OVER (PARTITION BY fullname ORDER BY event_ts NULLS LAST, author NULLS LAST) AS rn
    FROM social WHERE fullname IS NOT NULL)
  WHERE rn = 1
),
links AS (
  SELECT c.src, {_account("p.author")} AS dst, 'reply' AS edge_type, c.event_ts
  FROM comments c JOIN parents p ON c.parent_id = p.fullname
  UNION ALL
  SELECT src, {_account("name")}, 'mention', event_ts FROM (
    SELECT src, event_ts,
           unnest(list_distinct(regexp_extract_all(body, '{fixed.MENTION_PATTERN}', 1))) AS name
    FROM comments)
),
edges AS (
  SELECT src, dst, edge_type, count(*) AS weight, min(event_ts) AS first_seen, max(event_ts) AS last_seen
  FROM links WHERE src IS NOT NULL AND dst IS NOT NULL AND src <> dst GROUP BY ALL
),
directed AS (SELECT src, dst, CAST(sum(weight) AS BIGINT) AS weight FROM edges GROUP BY ALL),
pairs AS (
  SELECT least(src, dst) AS src, greatest(src, dst) AS dst, CAST(sum(weight) AS BIGINT) AS weight
  FROM edges GROUP BY ALL
),
nodes AS (SELECT src AS node FROM edges UNION SELECT dst FROM edges),
degrees AS (
  SELECT node, CAST(sum(i) AS BIGINT) AS in_degree_w, CAST(sum(o) AS BIGINT) AS out_degree_w,
         CAST(sum(i + o) AS BIGINT) AS degree_w
  FROM (SELECT src AS node, 0 AS i, weight AS o FROM directed
        UNION ALL SELECT dst, weight, 0 FROM directed) GROUP BY node
),
partition AS (SELECT node, CAST(regexp_extract(node, '[0-9]+') AS INT) % 5 AS community FROM nodes)"""

POLARITY_CTE = f"""{LEXICON_CTE},
polarity AS (
  SELECT d.doc_id, coalesce(avg(l.valence), 0.0) AS polarity
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{fixed.TOKEN_PATTERN}') || ['']) AS token
        FROM documents) d
  LEFT JOIN lexicon l USING (token) GROUP BY d.doc_id
)"""


def _case(column: str, table, otherwise: str) -> str:
    """The value of a string in a list of (string, value)."""
    return f"CASE {column} " + " ".join(f"WHEN {_text(k)} THEN {v}" for k, v in table) + f" ELSE {otherwise} END"


def _idiom_step(idioms) -> str:
    """v, or the value of the idiom that begins at the word, else of the nearest that ends there or before."""
    back = ("p1||' '||word", "p2||' '||p1||' '||word", "p3||' '||p2||' '||p1||' '||word", "p2||' '||p1", "p3||' '||p2||' '||p1", "p3||' '||p2")
    ahead = ("word||' '||after||' '||after2||' '||after3", "word||' '||after||' '||after2", "word||' '||after")
    found = ", ".join(_case(words, idioms, "NULL") for words in (*ahead, *back))
    return f"CASE WHEN p3 IS NOT NULL AND NOT known3 THEN coalesce({found}, v) ELSE v END"


def _degree_steps(rules) -> list[str]:
    """v with the step of each degree phrase before the word."""
    steps = [(w, fixed.BOOST) for w in rules.strengtheners if " " in w] + [(w, -fixed.BOOST) for w in rules.weakeners if " " in w]
    before = ("p3||' '||p2||' '||p1", "p3||' '||p2", "p2||' '||p1")
    return [f"CASE WHEN p3 IS NOT NULL AND NOT known3 THEN v + ({_case(words, steps, '0')}) ELSE v END" for words in before]


def _written(text: str, emoji) -> str:
    """A text with its signs written out, each after a space unless it begins the text or follows one."""
    word = _case("c", [(sign, _text(words)) for sign, words in emoji], "NULL")
    spaced = f"CASE WHEN i = 1 OR chars[i - 1] = ' ' THEN {word} ELSE ' ' || ({word}) END"
    return f"""array_to_string(list_transform(chars, lambda c, i: coalesce({spaced}, c)), '')"""


def _compound_cte(rules=RULES, idioms=(), emoji=()) -> str:
    """The compound score, word by word with window functions."""
    strong, weak = _listed(rules.strengtheners), _listed(rules.weakeners)
    negators = _listed(rules.negators)

    def upper(w: str) -> str:
        return f"(upper({w}) = {w} AND lower({w}) <> {w})"

    def sign(x: str) -> str:
        return f"CASE WHEN v > 0 THEN {x} ELSE -{x} END"

    steps = [
        f"""CASE WHEN coalesce(p1 = 'no', false) OR coalesce(p2 = 'no', false)
              OR (coalesce(p3 = 'no', false) AND coalesce(p1 IN ('or', 'nor'), false))
            THEN v * {fixed.NEGATION_FACTOR} WHEN word = 'no' AND known_after THEN 0 ELSE v END""",
        f"CASE WHEN mixed AND {upper('w')} THEN v + {sign(str(fixed.CAPS_BOOST))} ELSE v END",
    ]
    never = {
        1: "false",
        2: "p2 = 'never' AND p1 IN ('so', 'this')",
        3: "p3 = 'never' AND (p2 IN ('so', 'this') OR p1 IN ('so', 'this'))",
    }
    doubt = {
        1: "false",
        2: "p2 = 'without' AND p1 = 'doubt'",
        3: "p3 = 'without' AND (p2 = 'doubt' OR p1 = 'doubt')",
    }
    for k in (1, 2, 3):
        step = f"(CASE WHEN p{k} IN ({strong}) THEN {fixed.BOOST} ELSE -{fixed.BOOST} END)"
        step = f"(CASE WHEN v < 0 THEN -{step} ELSE {step} END)"
        loud = f"(CASE WHEN mixed AND {upper(f'w{k}')} THEN {sign(str(fixed.CAPS_BOOST))} ELSE 0 END)"
        plain = f"p{k} IS NOT NULL AND NOT known{k}"
        steps.append(
            f"CASE WHEN {plain} AND p{k} IN ({strong}, {weak}) "
            f"THEN v + ({step} + {loud}) * {fixed.BOOST_DECAY[k - 1]} ELSE v END"
        )
        steps.append(
            f"""CASE WHEN NOT ({plain}) THEN v WHEN {never[k]} THEN v * {fixed.NEVER_FACTOR}
                WHEN {doubt[k]} THEN v
                WHEN p{k} IN ({negators}) OR contains(p{k}, 'n''t') THEN v * {fixed.NEGATION_FACTOR} ELSE v END"""
        )
    steps += ([_idiom_step(idioms)] if idioms else []) + (_degree_steps(rules) if idioms else [])
    steps.append(
        f"""CASE WHEN p1 = 'least' AND NOT known1 AND coalesce(p2 NOT IN ('at', 'very'), true)
            THEN v * {fixed.NEGATION_FACTOR} ELSE v END"""
    )
    steps.append(
        f"""CASE WHEN word IN ({strong}, {weak}) OR (word = 'kind' AND coalesce(after = 'of', false)) THEN 0
            WHEN i < turn THEN v * {fixed.CONTRAST_BEFORE} WHEN i > turn THEN v * {fixed.CONTRAST_AFTER}
            ELSE v END"""
    )
    chain = "hits"
    for step in steps:
        chain = f"(SELECT * REPLACE ({step} AS v) FROM {chain})"
    space = "[" + fixed.WHITESPACE + "]+"
    source = f"SELECT doc_id, {_written('text', emoji)} AS text FROM (SELECT doc_id, string_split(text, '') AS chars FROM documents)"
    return f"""{LEXICON_CTE},
source AS ({source if emoji else "SELECT doc_id, text FROM documents"}),
pieces AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, {_text(space)}), lambda x: x <> '') AS ws
  FROM source
),
words AS (
  SELECT doc_id, i, CASE WHEN length(trim(raw, {PUNCT})) <= 2 THEN raw ELSE trim(raw, {PUNCT}) END AS w
  FROM (SELECT doc_id, unnest(ws) AS raw, unnest(range(len(ws))) AS i FROM pieces)
),
placed AS (
  SELECT *, lower(w) AS word, lag(w, 1) OVER o AS w1, lag(w, 2) OVER o AS w2, lag(w, 3) OVER o AS w3,
         lower(lead(w, 1) OVER o) AS after, lower(lead(w, 2) OVER o) AS after2, lower(lead(w, 3) OVER o) AS after3,
         min(CASE WHEN lower(w) = {_text(rules.contrast)} THEN i END) OVER (PARTITION BY doc_id) AS turn,
         sum(CASE WHEN {upper('w')} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS n_upper,
         count(*) OVER (PARTITION BY doc_id) AS n_words
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
hits AS (
  SELECT doc_id, i, w, word, w1, w2, w3, lower(w1) AS p1, lower(w2) AS p2, lower(w3) AS p3, after, after2, after3, turn,
         n_upper > 0 AND n_upper < n_words AS mixed, valence AS v,
         coalesce(lower(w1) IN (SELECT token FROM lexicon), false) AS known1,
         coalesce(lower(w2) IN (SELECT token FROM lexicon), false) AS known2,
         coalesce(lower(w3) IN (SELECT token FROM lexicon), false) AS known3,
         coalesce(after IN (SELECT token FROM lexicon), false) AS known_after
  FROM placed JOIN lexicon ON word = token
),
sums AS (SELECT doc_id, sum(v) AS s FROM {chain} GROUP BY doc_id),
marks AS (
  SELECT doc_id, text, len(text) - len(replace(text, '!', '')) AS cried,
         len(text) - len(replace(text, '?', '')) AS asked
  FROM source
),
emphatic AS (
  SELECT m.doc_id, m.text, coalesce(s, 0) AS s,
         least(cried, 4) * {fixed.EXCLAMATION_STEP}
         + CASE WHEN asked > 3 THEN {fixed.QUESTION_MAX} WHEN asked > 1 THEN asked * {fixed.QUESTION_STEP}
                ELSE 0 END AS emphasis
  FROM marks m LEFT JOIN sums USING (doc_id)
),
compounds AS (
  SELECT doc_id, text, CASE WHEN {_strip("text")} <> '' THEN round(
    (s + sign(s) * emphasis)
    / sqrt((s + sign(s) * emphasis) * (s + sign(s) * emphasis) + {fixed.NORMALISER}), 4) END AS compound
  FROM emphatic
)"""


COMPOUND_CTE = _compound_cte()

JUDGED_CTE = f"""{COMPOUND_CTE},
polarity AS (
  SELECT d.doc_id, coalesce(avg(l.valence), 0.0) AS polarity
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{fixed.TOKEN_PATTERN}') || ['']) AS token
        FROM documents) d
  LEFT JOIN lexicon l USING (token) GROUP BY d.doc_id
),
weak AS (
  SELECT doc_id, {_short_label("coalesce(compound, 0)", True)} AS compound_label,
         {_short_label("polarity", False)} AS polarity_label
  FROM compounds JOIN polarity USING (doc_id)
),
truth AS (
  SELECT doc_id, CASE WHEN toxic = 1 THEN 'neg' WHEN quality = 1 THEN 'pos' ELSE 'neu' END AS true_label
  FROM labels
),
judged AS (
  SELECT 'compound_label' AS model, true_label, compound_label AS predicted FROM truth JOIN weak USING (doc_id)
  UNION ALL
  SELECT 'polarity_label', true_label, polarity_label FROM truth JOIN weak USING (doc_id)
),
names(label) AS (VALUES ('neg'), ('neu'), ('pos')),
cells AS (
  SELECT m.model, t.label AS true_label, p.label AS predicted, count(j.model) AS n
  FROM (SELECT DISTINCT model FROM judged) m CROSS JOIN names t CROSS JOIN names p
  LEFT JOIN judged j ON j.model = m.model AND j.true_label = t.label AND j.predicted = p.label
  GROUP BY ALL
)"""


def _betweenness_cte(pivots: str) -> str:
    """Distances by relaxation, path counts by hops, then the sum over source and target pairs."""
    return f"""{EDGES_CTE},
chosen AS (
  SELECT node FROM (SELECT node, row_number() OVER (ORDER BY md5(concat('42:', node)), node) AS rn,
                           count(*) OVER () AS n FROM nodes)
  WHERE rn <= {pivots}
),
dist(s, v, d) USING KEY (s, v) AS (
  SELECT node, node, CAST(0 AS BIGINT) FROM nodes
  UNION
  SELECT x.s, e.dst, min(x.d + e.weight)
  FROM dist x JOIN directed e ON x.v = e.src
  LEFT JOIN recurring.dist r ON r.s = x.s AND r.v = e.dst
  WHERE r.d IS NULL OR x.d + e.weight < r.d
  GROUP BY x.s, e.dst
),
dag AS (
  SELECT a.s, a.v AS tail, e.dst AS head
  FROM dist a JOIN directed e ON a.v = e.src JOIN dist b ON b.s = a.s AND b.v = e.dst
  WHERE a.d + e.weight = b.d
),
walks(s, v, h, c) AS (
  SELECT node, node, 0, CAST(1 AS DOUBLE) FROM nodes
  UNION ALL
  SELECT w.s, g.head, w.h + 1, sum(w.c) FROM walks w JOIN dag g ON g.s = w.s AND g.tail = w.v
  GROUP BY w.s, g.head, w.h + 1
),
sigma AS (SELECT s, v, sum(c) AS c FROM walks GROUP BY s, v),
full_pairs AS (SELECT s, v, d, c FROM dist JOIN sigma USING (s, v)),
between_sum AS (
  SELECT x.v AS node, sum(x.c * y.c / z.c) AS value
  FROM full_pairs x JOIN chosen ON chosen.node = x.s
  JOIN full_pairs y ON y.s = x.v
  JOIN full_pairs z ON z.s = x.s AND z.v = y.v AND z.d = x.d + y.d
  WHERE x.s <> x.v AND y.v <> x.v AND x.s <> y.v
  GROUP BY x.v
),
size AS (SELECT count(*) AS n, (SELECT count(*) FROM chosen) AS k FROM nodes),
betweenness AS (
  SELECT node, round(coalesce(value, 0) / ((n - 1) * (n - 2)) * n / k, 9) AS betweenness
  FROM nodes CROSS JOIN size LEFT JOIN between_sum USING (node)
)"""


_STOP = _listed(STOP_WORDS)
_TRUTH = "CASE WHEN toxic = 1 THEN 'neg' WHEN quality = 1 THEN 'pos' ELSE 'neu' END"

_WINDOWS = """
SELECT time_bucket(INTERVAL '{size}', event_ts) AS window_start,
       time_bucket(INTERVAL '{size}', event_ts) + INTERVAL '{size}' AS window_end,
       topic, subreddit, count(*) AS volume, round(avg(CAST(score AS DOUBLE)), 6) AS avg_score{extra}
FROM social GROUP BY ALL"""

_SUBGRAPH = f"""{EDGES_CTE},
full_degrees AS (
  SELECT node, sum(weight) AS d FROM (SELECT src AS node, weight FROM pairs UNION ALL SELECT dst, weight FROM pairs)
  GROUP BY node
),
seeds AS (SELECT node FROM full_degrees ORDER BY d DESC, node LIMIT 60),
inside AS (SELECT * FROM pairs WHERE src IN (SELECT node FROM seeds) AND dst IN (SELECT node FROM seeds)),
inner_degrees AS (
  SELECT node, CAST(sum(weight) AS BIGINT) AS d
  FROM (SELECT src AS node, weight FROM inside UNION ALL SELECT dst, weight FROM inside) GROUP BY node
),
marked AS (
  SELECT seeds.node, CASE WHEN community = 4 THEN -1 ELSE community END AS community,
         coalesce(d, 0) AS degree_w
  FROM seeds JOIN partition USING (node) LEFT JOIN inner_degrees USING (node)
)"""

_TURNS = """
sized AS (
  SELECT conv_id, count(*) AS size, min(concat('c', conv_id, '_', turn)) AS first FROM conversations GROUP BY conv_id HAVING count(*) > 1
),
numbered AS (
  SELECT conv_id, size, CAST(row_number() OVER (ORDER BY size DESC, first) - 1 AS INT) AS community FROM sized
)"""

_TFIDF = f"""kept AS (
  SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{fixed.TOKEN_PATTERN}'),
                             lambda w: w NOT IN ({_STOP})) AS ws
  FROM documents
),
terms AS (
  SELECT doc_id, unnest(ws) AS term FROM kept
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(ws)), lambda i: concat(ws[i], ' ', ws[i + 1]))) FROM kept
),
counts AS (SELECT doc_id, term, count(*) AS n FROM terms GROUP BY ALL),
vocab AS (
  SELECT term, count(*) AS df, sum(n) AS cf FROM counts GROUP BY term HAVING count(*) >= 2
  ORDER BY cf DESC, term LIMIT 20000
),
size AS (SELECT count(*) AS n FROM documents),
weights AS (
  SELECT doc_id, term, c.n * (ln((1.0 + size.n) / (1.0 + df)) + 1.0) AS w
  FROM counts c JOIN vocab USING (term) CROSS JOIN size
),
norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM weights GROUP BY doc_id),
scaled AS (SELECT doc_id, term, w / norm AS w FROM weights JOIN norms USING (doc_id))"""

ORACLES: dict[str, str] = {
    "json_roundtrip_parse": f"""WITH {MESSAGES_CTE}
SELECT topic, kafka_ts, make_timestamp(CAST(seconds * 1000000 AS BIGINT)) AS event_ts,
       1 AS schema_version, 'fixture' AS source, CASE WHEN is_post THEN 'post' ELSE 'comment' END AS event_type,
       ingested_at, id, fullname, subreddit, CAST(NULL AS VARCHAR) AS subreddit_id, author,
       CAST(seconds AS DOUBLE) AS created_utc, CASE WHEN is_post THEN body END AS title,
       CASE WHEN is_post THEN '' END AS selftext, CASE WHEN NOT is_post THEN body END AS body,
       CAST(NULL AS VARCHAR) AS url, concat('/c/', id) AS permalink, CAST(NULL AS VARCHAR) AS link_id,
       parent_id, CAST(NULL AS INT) AS num_comments, score, CASE WHEN is_post THEN false END AS over_18,
       CASE WHEN is_post THEN true END AS is_self, {_clean("body")} AS text
FROM messages""",
    "epoch_event_time": """
SELECT event_id, make_timestamp(epoch_us(ts) // 1000000 * 1000000) AS whole_ts,
       make_timestamp(epoch_us(ts) // 1000000 * 1000000 + event_id % 4 * 250000) AS quarter_ts,
       make_timestamp((1729990800 + event_id) * 1000000) AS repeated_ts
FROM events""",
    "listing_unnest": """
SELECT 1 AS schema_version, 'fixture' AS source, CASE WHEN turn = 0 THEN 'post' ELSE 'comment' END AS event_type,
       '2024-01-01T00:00:00+00:00' AS ingested_at, concat(conv_id, '_', turn) AS id,
       concat(CASE WHEN turn = 0 THEN 't3_' ELSE 't1_' END, conv_id, '_', turn) AS fullname,
       concat('c', conv_id) AS subreddit, CAST(NULL AS VARCHAR) AS subreddit_id, role AS author,
       CAST(turn AS DOUBLE) AS created_utc, CASE WHEN turn = 0 THEN text END AS title,
       CAST(NULL AS VARCHAR) AS selftext, CAST(NULL AS VARCHAR) AS url, CAST(NULL AS VARCHAR) AS permalink,
       CAST(NULL AS INT) AS num_comments, CAST(NULL AS INT) AS score, CAST(NULL AS BOOLEAN) AS over_18,
       CAST(NULL AS BOOLEAN) AS is_self, CASE WHEN turn > 0 THEN text END AS body,
       CAST(NULL AS VARCHAR) AS link_id,
       CASE WHEN turn > 0 THEN concat('t1_', conv_id, '_', turn - 1) END AS parent_id
FROM conversations WHERE role <> 'system'""",
    "clean_text": f"""
SELECT doc_id, {_clean("concat_ws(' ', source, text)")} AS cleaned FROM documents""",
    "text_fallback": f"""
WITH shaped AS (
  SELECT doc_id, source, concat(chr(9), chr(12288), text, ' ', chr(10)) AS padded, doc_id % 5 AS which
  FROM documents
),
chosen AS (
  SELECT doc_id, CASE WHEN which IN (0, 1) THEN {_strip("padded")}
                      WHEN which = 3 THEN {_strip("concat(trim(source), chr(10), " + _strip("padded") + ")")}
                      ELSE {_strip("source")} END AS chosen
  FROM shaped
)
SELECT doc_id, chosen, CAST(length(chosen) AS INT) AS text_len FROM chosen""",
    "label_text_clean": """
WITH decoded AS (
  SELECT page_id, replace(replace(replace(replace(
    regexp_replace(html, '[^\\x00-\\x7F]', '', 'g'),
    '&copy;', chr(169)), '&middot;', chr(183)), '&quot;', '"'), '&amp;', '&') AS t
  FROM pages
)
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(t, 'http\\S+', '', 'g'),
         '\\[([^\\]]+)\\]\\([^)]+\\)', '\\1', 'g'), '\\s+', ' ', 'g')) AS cleaned
FROM decoded""",
    "label_set_build": """
WITH cleaned AS (
  SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'), 'http\\S+', '', 'g'),
    '\\[([^\\]]+)\\]\\([^)]+\\)', '\\1', 'g'), '\\s+', ' ', 'g')) AS text
  FROM documents WHERE text IS NOT NULL
)
SELECT doc_id, text, '' AS true_label FROM cleaned WHERE length(text) >= 10
ORDER BY md5(concat('42:', doc_id)), doc_id LIMIT 100""",
    "corpus_export": f"""WITH {MESSAGES_CTE}
SELECT id, CAST(seconds AS DOUBLE) AS created_utc, subreddit, author, coalesce(score, 0) AS score,
       CAST(NULL AS VARCHAR) AS link_id, parent_id, concat('/c/', id) AS permalink,
       'comment' AS event_type, ingested_at, {_strip("body")} AS text
FROM messages WHERE NOT is_post AND length({_strip("body")}) >= 5""",
    "mention_extract": f"""WITH {SOCIAL_CTE}
SELECT id, unnest(list_distinct(regexp_extract_all(body, '{fixed.MENTION_PATTERN}', 1))) AS mention
FROM social""",
    "contract_violations": f"""WITH {SOCIAL_CTE}
SELECT fullname AS key, topic, CASE event_id % 10
  WHEN 0 THEN 'not_json' WHEN 1 THEN 'missing:id' WHEN 2 THEN 'type:score' WHEN 3 THEN 'const:schema_version'
  WHEN 4 THEN 'type:created_utc' WHEN 5 THEN 'null:ingested_at' WHEN 6 THEN 'const:event_type'
  WHEN 7 THEN 'type:author' WHEN 8 THEN 'missing:subreddit' ELSE '' END AS violations
FROM social""",
    "window_volume_score": f"""WITH {SOCIAL_CTE}
{_WINDOWS.format(size="5 minutes", extra=", '5 minutes' AS size")} UNION ALL
{_WINDOWS.format(size="6 hours", extra=", '6 hours' AS size")}""",
    "window_volume_topic": f"""WITH {SOCIAL_CTE}
SELECT time_bucket(INTERVAL '5 minutes', kafka_ts) AS window_start,
       time_bucket(INTERVAL '5 minutes', kafka_ts) + INTERVAL '5 minutes' AS window_end,
       topic, count(*) AS volume FROM social GROUP BY ALL""",
    "top_channels_last_hour": f"""WITH {SOCIAL_CTE}
SELECT subreddit, count(*) AS volume FROM social
WHERE time_bucket(INTERVAL '5 minutes', event_ts) >= (SELECT max(event_ts) FROM social) - INTERVAL '1 hour'
GROUP BY subreddit ORDER BY volume DESC, subreddit LIMIT 10""",
    "latest_rows": f"""WITH {SOCIAL_CTE}
SELECT id, event_ts, topic, subreddit FROM social ORDER BY event_ts DESC, id LIMIT 20""",
    "latest_windows": f"""WITH {SOCIAL_CTE}
SELECT time_bucket(INTERVAL '5 minutes', kafka_ts) AS window_start,
       time_bucket(INTERVAL '5 minutes', kafka_ts) + INTERVAL '5 minutes' AS window_end,
       topic, count(*) AS volume FROM social GROUP BY ALL ORDER BY window_start DESC, topic LIMIT 5""",
    "kpi_counts": f"""WITH {EDGES_CTE}
SELECT 'raw' AS metric, count(*) AS value FROM social
UNION ALL SELECT 'processed', count(*) FROM social WHERE id IS NOT NULL
UNION ALL SELECT 'edges', count(*) FROM edges
UNION ALL SELECT 'nodes', count(*) FROM nodes""",
    "incremental_watermark": f"""WITH {SOCIAL_CTE},
items AS (
  SELECT topic AS kind, subreddit AS channel, epoch_us(event_ts) // 1000000 AS created_utc FROM social
),
known AS (
  SELECT kind, channel, CASE WHEN channel = 'r6' THEN max(created_utc)
         ELSE (min(created_utc) + max(created_utc)) // 2 END AS last
  FROM items WHERE channel <> 'r7' GROUP BY kind, channel
),
fresh AS (
  SELECT i.* FROM items i LEFT JOIN known k USING (kind, channel) WHERE i.created_utc > coalesce(k.last, 0)
)
SELECT kind, channel, max(last) AS last_created_utc, CAST(sum(n) AS BIGINT) AS n_new FROM (
  SELECT kind, channel, last, 0 AS n FROM known
  UNION ALL SELECT kind, channel, max(created_utc), count(*) FROM fresh GROUP BY kind, channel)
GROUP BY kind, channel""",
    "reply_edges": f"WITH {EDGES_CTE} SELECT * FROM edges WHERE edge_type = 'reply'",
    "stream_reply_edges": f"""WITH {EDGES_CTE}
SELECT src, dst, edge_type, weight, date_trunc('second', first_seen) + INTERVAL 500 MILLISECOND AS first_seen,
       date_trunc('second', last_seen) + INTERVAL 500 MILLISECOND AS last_seen
FROM edges WHERE edge_type = 'reply'""",
    "mention_edges": f"WITH {EDGES_CTE} SELECT * FROM edges WHERE edge_type = 'mention'",
    "interaction_edges": f"WITH {EDGES_CTE} SELECT * FROM edges",
    "edges_incremental_merge": f"WITH {EDGES_CTE} SELECT * FROM edges",
    "edges_bucketed_merge": f"WITH {EDGES_CTE} SELECT * FROM edges",
    "weighted_degree": f"WITH {EDGES_CTE} SELECT * FROM degrees",
    "top_weighted_degree": f"WITH {EDGES_CTE} SELECT * FROM degrees ORDER BY degree_w DESC, node LIMIT 50",
    "undirected_graph": f"WITH {EDGES_CTE} SELECT * FROM pairs",
    "modularity_of_partition": f"""WITH {EDGES_CTE},
marked AS (
  SELECT weight, a.community AS x, b.community AS y
  FROM pairs JOIN partition a ON a.node = src JOIN partition b ON b.node = dst
),
ends AS (
  SELECT x AS c, CASE WHEN x = y THEN weight ELSE 0 END AS inside, weight FROM marked
  UNION ALL SELECT y, 0, weight FROM marked
),
sums AS (SELECT c, CAST(sum(inside) AS DOUBLE) AS l, CAST(sum(weight) AS DOUBLE) AS d FROM ends GROUP BY c)
SELECT count(*) AS communities, round(2 * sum(l) / sum(d) - sum(d * d) / (sum(d) * sum(d)), 9) AS modularity
FROM sums""",
    "top_degree_subgraph_nodes": f"""WITH {_SUBGRAPH}
SELECT node, community, degree_w, greatest(20, least(800, degree_w * 2)) AS marker_size FROM marked""",
    "top_degree_subgraph_edges": f"""WITH {_SUBGRAPH}
SELECT src, dst, weight, a.community AS src_comm, b.community AS dst_comm
FROM inside JOIN marked a ON a.node = src JOIN marked b ON b.node = dst""",
    "betweenness_exact": f"""WITH RECURSIVE {_betweenness_cte("n")}
SELECT node, in_degree_w, out_degree_w, degree_w, betweenness FROM degrees JOIN betweenness USING (node)""",
    "betweenness_sampled": f"""WITH RECURSIVE {_betweenness_cte("32")}
SELECT node, betweenness FROM betweenness""",
    "eigenvector": f"""WITH RECURSIVE {EDGES_CTE},
power(node, x, h) AS (
  SELECT node, CAST(1 AS DOUBLE), 0 FROM nodes
  UNION ALL
  SELECT node, x / sqrt(sum(x * x) OVER ()), h + 1 FROM (
    SELECT node, h, sum(x) AS x FROM (
      SELECT node, x, h FROM power WHERE h < 100
      UNION ALL
      SELECT d.dst, p.x * d.weight, p.h FROM power p JOIN directed d ON d.src = p.node WHERE p.h < 100)
    GROUP BY node, h)
)
SELECT node, round(x, 6) AS centrality FROM power WHERE h = 100""",
    "jsonl_roundtrip": "SELECT doc_id, lang, n_chars, text FROM documents",
    "jsonl_utf16_roundtrip": "SELECT doc_id, lang, n_chars, text FROM documents",
    "csv_roundtrip": "SELECT doc_id, text, source FROM documents",
    "table_roundtrip": "SELECT doc_id, source FROM documents WHERE n_chars > 500",
    "lexicon_sentiment": f"""WITH {COMPOUND_CTE}
SELECT doc_id, round(compound, 3) AS sentiment_compound,
       {_short_label("compound", True, fixed.LONG_LABELS)} AS sentiment_label,
       TIMESTAMP '2024-01-01 00:00:00' AS scored_at
FROM compounds WHERE length(text) > 0""",
    "lexicon_sentiment_repeated_ids": f"""WITH {COMPOUND_CTE}
SELECT doc_id, CASE WHEN doc_id % 7 > 0 THEN doc_id % 50 END AS id, round(compound, 3) AS sentiment_compound
FROM compounds WHERE length(text) > 0""",
    "louvain_of_turns": f"""WITH {_TURNS} SELECT concat('c', conv_id, '_', turn) AS node, community FROM conversations JOIN numbered USING (conv_id)""",
    "louvain_of_turns_summary": f"""WITH {_TURNS},
total AS (SELECT sum(size) AS nodes, sum(size - 1) AS edges, count(*) AS communities FROM numbered)
SELECT 'louvain' AS algo, CAST(nodes AS BIGINT) AS nodes, CAST(edges AS BIGINT) AS edges, communities,
       round((SELECT sum((size - 1) / edges - ((size - 1) / edges) ** 2) FROM numbered, total), 9) AS modularity,
       (SELECT string_agg(concat(community, ':', size), ',' ORDER BY community) FROM numbered WHERE community < 10) AS top10_sizes
FROM total""",
    "publish_order": f"""WITH {SOCIAL_CTE}
SELECT fullname, row_number() OVER (ORDER BY event_ts, fullname) - 1 AS position FROM social""",
    "lexicon_idioms": f"""WITH {_compound_cte(PHRASE_RULES, IDIOMS, EMOJI)}
SELECT doc_id, compound FROM compounds""",
    "mean_polarity": f"""WITH {POLARITY_CTE}
SELECT doc_id, round(polarity, 6) + 0.0 AS polarity, {_short_label("polarity", False)} AS label FROM polarity""",
    "sentiment_distribution": f"""WITH {POLARITY_CTE}
SELECT {_short_label("polarity", False)} AS label, count(*) AS count
FROM polarity JOIN documents USING (doc_id) WHERE lang <> 'fr' GROUP BY 1""",
    "label_crosstab": f"""WITH {JUDGED_CTE}
SELECT compound_label, polarity_label, count(*) AS count FROM weak GROUP BY ALL
ORDER BY count DESC, compound_label, polarity_label LIMIT 10""",
    "unscored_only": f"""WITH {POLARITY_CTE}
SELECT doc_id, {_TRUTH} AS label FROM labels
UNION ALL
SELECT doc_id, {_short_label("polarity", False)} FROM polarity WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "confusion_matrix": f"""WITH {JUDGED_CTE}
SELECT model, true_label, CAST(sum(n) FILTER (predicted = 'neg') AS BIGINT) AS neg,
       CAST(sum(n) FILTER (predicted = 'neu') AS BIGINT) AS neu,
       CAST(sum(n) FILTER (predicted = 'pos') AS BIGINT) AS pos
FROM cells GROUP BY model, true_label""",
    "classification_report": f"""WITH {JUDGED_CTE},
tallies AS (
  SELECT c.model, l.label, sum(n) FILTER (true_label = l.label AND predicted = l.label) AS hit,
         sum(n) FILTER (predicted = l.label) AS guessed, sum(n) FILTER (true_label = l.label) AS support
  FROM cells c CROSS JOIN names l GROUP BY ALL
),
rates AS (
  SELECT *, CASE WHEN guessed = 0 THEN 0.0 ELSE hit / guessed END AS p,
         CASE WHEN support = 0 THEN 0.0 ELSE hit / support END AS r FROM tallies
),
scored AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM rates)
SELECT model, label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM scored
UNION ALL SELECT model, 'accuracy', NULL, NULL, round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT)
  FROM scored GROUP BY model
UNION ALL SELECT model, 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6),
  CAST(sum(support) AS BIGINT) FROM scored GROUP BY model
UNION ALL SELECT model, 'weighted avg', round(sum(p * support) / sum(support), 6),
  round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM scored GROUP BY model""",
    "stratified_split": """
SELECT doc_id, quality, CAST(rn <= ceil(0.25 * n) AS INT) AS is_test FROM (
  SELECT doc_id, quality, count(*) OVER (PARTITION BY quality) AS n,
         row_number() OVER (PARTITION BY quality ORDER BY md5(concat('42:', doc_id)), doc_id) AS rn
  FROM labels)""",
    "nmf_leading_topic": f"""
WITH RECURSIVE {_TFIDF.replace("scaled AS (", "scaled AS MATERIALIZED (")},
power AS (
  SELECT 0 AS i, term, CAST(1 AS DOUBLE) AS x FROM vocab
  UNION ALL
  SELECT i + 1, term, sum(w * y) FROM (
    SELECT i, doc_id, sum(w * x) AS y FROM power JOIN scaled USING (term) WHERE i < 60 GROUP BY i, doc_id
  ) JOIN scaled USING (doc_id) GROUP BY i, term
),
main_vector AS (SELECT term, x / sqrt(sum(x * x) OVER ()) AS x FROM power WHERE i = 60)
SELECT term, round(x, 5) AS weight FROM main_vector WHERE round(x, 5) >= 0.01""",
    "tfidf_repeated_ids": f"""
WITH {_TFIDF},
ranked AS (
  SELECT doc_id, term, w, row_number() OVER (PARTITION BY doc_id ORDER BY round(w, 9) DESC, term) AS rank
  FROM scaled
)
SELECT doc_id, CASE WHEN doc_id % 7 > 0 THEN doc_id % 50 END AS id, term, round(round(w, 9), 6) AS weight FROM ranked WHERE rank = 1""",
    "tfidf_top_terms": f"""
WITH {_TFIDF},
ranked AS (
  SELECT doc_id, term, w, row_number() OVER (PARTITION BY doc_id ORDER BY round(w, 9) DESC, term) AS rank
  FROM scaled
)
SELECT doc_id, CAST(rank AS INT) AS rank, term, round(round(w, 9), 6) AS weight FROM ranked WHERE rank <= 5""",
    "top_authors_per_window": f"""WITH {SOCIAL_CTE},
counts AS (
  SELECT time_bucket(INTERVAL '1 day', event_ts) AS window_start, author, count(*) AS volume
  FROM social WHERE author IS NOT NULL GROUP BY ALL
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY volume DESC, author) AS INT) AS rank
  FROM counts
)
SELECT window_start, window_start + INTERVAL '1 day' AS window_end, author, volume, rank
FROM ranked WHERE rank <= 3""",
    "top_channels_per_window": f"""WITH {SOCIAL_CTE},
counts AS (
  SELECT time_bucket(INTERVAL '6 hours', event_ts) AS window_start, subreddit, count(*) AS volume
  FROM social GROUP BY ALL
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY volume DESC, subreddit) AS INT) AS rank
  FROM counts
)
SELECT window_start, window_start + INTERVAL '6 hours' AS window_end, subreddit, volume, rank
FROM ranked WHERE rank <= 2""",
    "sentiment_trend": """
WITH labelled AS (
  SELECT time_bucket(INTERVAL '1 day', ts) AS window_start,
         CASE event_type WHEN 'error' THEN 'neg' WHEN 'purchase' THEN 'pos' WHEN 'signup' THEN 'pos'
                         ELSE 'neu' END AS label
  FROM events
),
counts AS (SELECT window_start, label, count(*) AS volume FROM labelled GROUP BY ALL)
SELECT window_start, window_start + INTERVAL '1 day' AS window_end, label, volume,
       round(volume / sum(volume) OVER (PARTITION BY window_start), 6) AS share
FROM counts""",
    "stream_window_update": f"""WITH {SOCIAL_CTE} {_WINDOWS.format(size="6 hours", extra="")}""",
    "stream_window_compacted": f"""WITH {SOCIAL_CTE} {_WINDOWS.format(size="6 hours", extra="")}""",
    "stream_window_append": f"""WITH {SOCIAL_CTE},
windows AS (
  SELECT time_bucket(INTERVAL '5 minutes', kafka_ts) AS window_start,
         time_bucket(INTERVAL '5 minutes', kafka_ts) + INTERVAL '5 minutes' AS window_end,
         topic, count(*) AS volume FROM social GROUP BY ALL
)
SELECT * FROM windows WHERE window_end <= (SELECT max(kafka_ts) FROM social) - INTERVAL '10 minutes'""",
    "stream_raw_processed": f"""WITH {SOCIAL_CTE}
SELECT topic, count(*) AS raw_rows, count(*) AS processed_rows,
       CAST(sum(length({_clean("body")})) AS BIGINT) AS text_chars, CAST(sum(score) AS BIGINT) AS score_sum
FROM social GROUP BY topic""",
    "stream_dedupe": f"""WITH {MESSAGES_CTE}
SELECT fullname, topic, make_timestamp(CAST(seconds * 1000000 AS BIGINT)) AS event_ts, {_clean("body")} AS text
FROM messages""",
    "stream_scoring": f"""WITH {POLARITY_CTE}
SELECT doc_id, {_short_label("polarity", False)} AS label FROM polarity""",
}

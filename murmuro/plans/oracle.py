"""The same results in plain SQL, written independently of the Spark jobs."""

from __future__ import annotations

from murmuro import fixed_values as fixed
from murmuro import sample_tables as sample


def literal(value) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def word_list(words) -> str:
    return "(" + ", ".join(literal(w) for w in words) + ")"


def rows(name: str, columns: str, values: list[tuple]) -> str:
    """A CTE holding constant rows."""
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in values)
    return f"{name}({columns}) AS (VALUES {body})"


def union(first: str, *others: str) -> str:
    return first + "".join(f" UNION ALL {o}" for o in others)


# Shared parts

COMMENTS = """comments AS (
  SELECT d.doc_id, d.source AS video_id, d.text, d.lang, CAST(floor(o.o_totalprice / 1000) AS BIGINT) AS likes,
         o.o_orderdate AS published_at, c.c_name AS author
  FROM documents d JOIN orders o ON d.doc_id = o.o_orderkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey)"""

POLARITIES = rows("lex", "word, polarity, subjectivity", sample.POLARITIES)
VALENCES = rows("val", "word, valence", sample.VALENCES)
EMOTIONS = rows("emo", "word, emotion", sample.EMOTION_WORDS)

WORDS = r"""words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}'']+')) AS word FROM documents)"""

POLARITY = f"""{POLARITIES}, {WORDS},
pol AS (SELECT doc_id, round(avg(CAST(polarity AS DOUBLE)), 9) AS polarity,
               round(avg(CAST(subjectivity AS DOUBLE)), 9) AS subjectivity
        FROM words JOIN lex USING (word) GROUP BY doc_id),
scored AS (SELECT d.doc_id, d.text, d.lang, coalesce(polarity, 0.0) AS polarity,
                  coalesce(subjectivity, 0.0) AS subjectivity FROM documents d LEFT JOIN pol USING (doc_id)),
labelled AS (SELECT *, CASE WHEN polarity > 0 THEN 'positive' WHEN polarity < 0 THEN 'negative' ELSE 'neutral' END
             AS sentiment FROM scored)"""

RATED = f"""{COMMENTS}, {POLARITY},
rated AS (SELECT c.*, l.sentiment, l.polarity AS sentiment_score, coalesce(e.label, -1) AS topic
          FROM comments c JOIN labelled l USING (doc_id) LEFT JOIN embeddings e ON e.vec_id = c.doc_id)"""


def no_runs(text: str) -> str:
    """Text without the third and later repeat of any character but a line break."""
    return (
        f"array_to_string(list_filter(string_split({text}, ''), lambda ch, i: NOT (i > 2 AND ch <> chr(10) "
        f"AND string_split({text}, '')[i - 1] = ch AND string_split({text}, '')[i - 2] = ch)), '')"
    )


# The split is done once in its own step: (key, chars) -> joined text without runs.
def no_runs_step(name: str, source: str, key: str, text: str) -> str:
    return f"""{name}_chars AS (SELECT {key}, string_split({text}, '') AS a FROM {source}),
{name} AS (SELECT {key}, array_to_string(list_filter(a, lambda ch, i: NOT (i > 2 AND ch <> chr(10)
           AND a[i - 1] = ch AND a[i - 2] = ch)), '') AS t FROM {name}_chars)"""


def cleaned(source: str, key: str, text: str) -> str:
    """Ends in `clean(key, t)`. The driver's texts hold at most four kinds of entity and are already NFKC."""
    decoded = text
    for entity, sign in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
        decoded = f"replace({decoded}, {literal(entity)}, {literal(sign)})"
    stripped = rf"regexp_replace(regexp_replace({decoded}, '<[^>]+>', ' ', 'g'), 'https?://\S+|www\.\S+', ' ', 'g')"
    printable = rf"regexp_replace({stripped}, '[^\t\n\r\x20-\x7E\x{{A0}}-\x{{FFFF}}]', '', 'g')"
    return f"""{no_runs_step("short", source, key, printable)},
clean AS (SELECT {key}, trim(regexp_replace(t, '[\\s\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{3000}}]+', ' ', 'g')) AS t
          FROM short)"""


CLEAN_DOCS = cleaned("documents", "doc_id", "text")
UNIQUE_DOCS = f"""{CLEAN_DOCS},
uniq AS (SELECT min(doc_id) AS doc_id, t AS text FROM clean WHERE length(t) >= 3 GROUP BY t)"""

_PREPARED = r"""regexp_replace(regexp_replace(regexp_replace(lower(text), 'http\S+|www\.\S+', '', 'g'), '<.*?>', '', 'g'),
 '[^\x00-\x7F]', '', 'g')"""
NORMALISED = f"""{no_runs_step("plain", "documents", "doc_id", _PREPARED)},
norm AS (SELECT doc_id, regexp_replace(t, '[!-/:-@\\[-`{{-~]', '', 'g') AS t FROM plain)"""
_SPLIT = "t"
for _pair in (r"(can)(not)", r"(gim|lem)(me)", r"(gon|wan)(na)", r"(got)(ta)"):
    _SPLIT = rf"regexp_replace({_SPLIT}, '\b{_pair}\b', '\1 \2', 'g')"
STOP = word_list([*fixed.ENGLISH_STOP_WORDS, *fixed.CUSTOM_STOP_WORDS])
TOKENS = f"""{NORMALISED},
arrays AS (SELECT doc_id, list_filter(regexp_extract_all({_SPLIT}, '[^\\s\\x1c-\\x1f]+'),
           lambda w: regexp_matches(w, '^[a-z]+$') AND w NOT IN {STOP}) AS toks FROM norm),
tok AS (SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM arrays),
vocab AS (SELECT token, count(*) AS n FROM tok GROUP BY token)"""
GRAMS2 = """grams AS (SELECT a.token || ' ' || b.token AS gram, a.token AS w0, b.token AS w1
  FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1)"""
GRAMS3 = """grams AS (SELECT a.token || ' ' || b.token || ' ' || c.token AS gram, a.token AS w0, b.token AS w1, c.token AS w2
  FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 JOIN tok c ON a.doc_id = c.doc_id AND c.pos = a.pos + 2)"""
# All tokens as one list.
LINED = "lined AS (SELECT token, row_number() OVER (ORDER BY doc_id, pos) AS at FROM tok)"
SPAN2 = f"""{LINED}, grams AS (SELECT a.token || ' ' || b.token AS gram, a.token AS w0, b.token AS w1
  FROM lined a JOIN lined b ON b.at = a.at + 1)"""
SPAN3 = f"""{LINED}, grams AS (SELECT a.token || ' ' || b.token || ' ' || c.token AS gram
  FROM lined a JOIN lined b ON b.at = a.at + 1 JOIN lined c ON c.at = a.at + 2)"""
TOP_GRAMS = "SELECT gram, count(*) AS count FROM grams GROUP BY gram ORDER BY count DESC, gram LIMIT 20"


def pmi(n: int) -> str:
    names = [f"w{i}" for i in range(n)]
    joins = " ".join(f"JOIN vocab v{i} ON v{i}.token = g.w{i}" for i in range(n))
    product = " * ".join(f"CAST(v{i}.n AS DOUBLE)" for i in range(n))
    return f"""SELECT g.gram, g.c AS freq, round(round(log2(g.c * power((SELECT sum(n) FROM vocab)::DOUBLE, {n - 1}))
  - log2({product}), 9), 6) AS pmi
  FROM (SELECT gram, {", ".join(names)}, count(*) AS c FROM grams GROUP BY ALL HAVING count(*) >= 3) g {joins}
  ORDER BY round(log2(g.c * power((SELECT sum(n) FROM vocab)::DOUBLE, {n - 1})) - log2({product}), 9) DESC, gram LIMIT 20"""


DAY = "strftime({}, '%Y-%m-%d')"
ENGLISH = word_list(fixed.ENGLISH_STOP_WORDS)


def terms(source: str, label: str) -> str:
    """Ends in `terms(label, term)`: uni- and bigrams without English stop words."""
    return rf"""feat AS (SELECT {label} AS label, list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}'),
    lambda w: w NOT IN {ENGLISH}) AS f FROM {source}),
terms AS (SELECT label, unnest(f) AS term FROM feat
  UNION ALL SELECT label, unnest(list_transform(range(1, greatest(len(f), 1)), lambda i: f[i] || ' ' || f[i + 1])) FROM feat)"""


def distinctive(prefix: str, source: str, label: str) -> str:
    return f"""WITH {prefix}{terms(source, label)},
tf AS (SELECT label, term, count(*) AS c FROM terms WHERE label IS NOT NULL GROUP BY ALL),
best AS (SELECT term FROM tf GROUP BY term ORDER BY sum(c) DESC, term LIMIT 5000),
kept AS (SELECT * FROM tf JOIN best USING (term)),
idf AS (SELECT term, ln((1 + (SELECT count(DISTINCT label) FROM tf)) / (1 + count(*))) + 1 AS idf FROM kept GROUP BY term),
w AS (SELECT label, term, c * idf AS w FROM kept JOIN idf USING (term)),
s AS (SELECT label, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY label)), 9) AS score FROM w)
SELECT label AS {label}, row_number() OVER (PARTITION BY label ORDER BY score DESC, term) AS rank, term, round(score, 6) AS score
FROM s WHERE (SELECT count(DISTINCT label) FROM tf) >= 2
QUALIFY row_number() OVER (PARTITION BY label ORDER BY score DESC, term) <= 12"""


# Rule-based sentiment

_UP, _DOWN, _NO = word_list(fixed.BOOSTERS_UP), word_list(fixed.BOOSTERS_DOWN), word_list(fixed.NEGATORS)


def _boost(p: str, v: str) -> str:
    size = f"(CASE WHEN lower({p}) IN {_UP} THEN 0.293::DOUBLE WHEN lower({p}) IN {_DOWN} THEN -0.293::DOUBLE ELSE 0::DOUBLE END)"
    loud = f"(CASE WHEN {size} <> 0 AND mixed AND upper({p}) = {p} AND lower({p}) <> {p} THEN 0.733::DOUBLE ELSE 0::DOUBLE END)"
    return f"(CASE WHEN {v} < 0 THEN -{size} ELSE {size} END + CASE WHEN {v} > 0 THEN {loud} ELSE -{loud} END)"


def _negated(p: str) -> str:
    return f"(lower({p}) IN {_NO} OR contains(lower({p}), 'n''t'))"


def _step(i: int, v: str, damping: str) -> str:
    p = f"p{i}"
    b = f"({v} + {_boost(p, v)} * {damping})"
    plain = f"CASE WHEN {_negated(p)} THEN {b} * -0.74::DOUBLE ELSE {b} END"
    if i == 2:
        plain = (
            f"CASE WHEN lower(p2) = 'never' AND lower(p1) IN ('so', 'this') THEN {b} * 1.25::DOUBLE "
            f"WHEN lower(p2) = 'without' AND lower(p1) = 'doubt' THEN {b} ELSE {plain} END"
        )
    if i == 3:
        plain = (
            f"CASE WHEN lower(p3) = 'never' AND (lower(p1) IN ('so', 'this') OR lower(p2) IN ('so', 'this')) "
            f"THEN {b} * 1.25::DOUBLE WHEN lower(p3) = 'without' AND (lower(p1) = 'doubt' OR lower(p2) = 'doubt') "
            f"THEN {b} ELSE {plain} END"
        )
    free = f"{p} IS NOT NULL AND lower({p}) NOT IN (SELECT word FROM val)"
    return f"CASE WHEN {free} THEN {plain} ELSE {v} END"


_EDGE = "'^[!-/:-@\\[-`{-~]+|[!-/:-@\\[-`{-~]+$'"
RULES = rf"""{VALENCES},
raw AS (SELECT doc_id, text, list_transform(regexp_extract_all(text, '\S+'), lambda w:
    CASE WHEN length(regexp_replace(w, {_EDGE}, '', 'g')) <= 2 THEN w ELSE regexp_replace(w, {_EDGE}, '', 'g') END) AS ws
  FROM documents),
flags AS (SELECT doc_id, ws, len(list_filter(ws, lambda w: upper(w) = w AND lower(w) <> w)) AS caps,
    list_position(list_transform(ws, lambda w: lower(w)), 'but') AS but_at,
    least(length(text) - length(replace(text, '!', '')), 4) AS bangs,
    length(text) - length(replace(text, '?', '')) AS asks FROM raw),
tk AS (SELECT doc_id, caps > 0 AND caps < len(ws) AS mixed, coalesce(but_at, 0) AS but_at, bangs, asks,
    unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM flags),
ctx AS (SELECT *, lag(w, 1) OVER o AS p1, lag(w, 2) OVER o AS p2, lag(w, 3) OVER o AS p3 FROM tk
  WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
hit AS (SELECT ctx.*, CAST(val.valence AS DOUBLE) + CASE WHEN mixed AND upper(w) = w AND lower(w) <> w
    THEN sign(val.valence) * 0.733::DOUBLE ELSE 0::DOUBLE END AS v0 FROM ctx JOIN val ON val.word = lower(ctx.w)
    WHERE lower(ctx.w) NOT IN {_UP} AND lower(ctx.w) NOT IN {_DOWN}),
h1 AS (SELECT *, {_step(1, "v0", "1::DOUBLE")} AS v1 FROM hit),
h2 AS (SELECT *, {_step(2, "v1", "0.95::DOUBLE")} AS v2 FROM h1),
h3 AS (SELECT *, {_step(3, "v2", "0.9::DOUBLE")} AS v3 FROM h2),
sums AS (SELECT doc_id, round(sum(CASE WHEN but_at > 0 AND pos < but_at THEN v3 * 0.5::DOUBLE
    WHEN but_at > 0 AND pos > but_at THEN v3 * 1.5::DOUBLE ELSE v3 END), 9) AS s, max(bangs) AS bangs, max(asks) AS asks
  FROM h3 GROUP BY doc_id),
loud AS (SELECT doc_id, s, bangs * 0.292::DOUBLE + CASE WHEN asks > 3 THEN 0.96::DOUBLE WHEN asks > 1 THEN asks * 0.18::DOUBLE
    ELSE 0::DOUBLE END AS e FROM sums),
tot AS (SELECT doc_id, CASE WHEN s > 0 THEN s + e WHEN s < 0 THEN s - e ELSE 0::DOUBLE END AS x FROM loud),
rule AS (SELECT d.doc_id, d.text, coalesce(round(x / sqrt(x * x + 15), 4), 0::DOUBLE) AS sentiment_score
  FROM documents d LEFT JOIN tot USING (doc_id))"""


# Phrases

def matched(gazetteer: list[tuple]) -> str:
    """Ends in `hits(doc_id, n, entity)`. Leftmost-longest matching through a regular expression whose
    alternatives run from long to short, over words wrapped in single spaces."""
    phrases = sorted({p for p, *_ in gazetteer}, key=lambda p: (-len(p.split()), p))
    pattern = "|".join(" " + "  ".join(p.split()) + " " for p in phrases)
    best = {}
    for phrase, label, score in gazetteer:
        if phrase not in best or (-score, label) < (-best[phrase][1], best[phrase][0]):
            best[phrase] = (label, score)
    labels = rows("gaz", "phrase, label", [(p, l) for p, (l, _) in best.items()])
    return rf"""{labels},
ws AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[\p{{L}}\p{{N}}'']+'), lambda w: ' ' || w || ' ') AS ws FROM documents),
found AS (SELECT doc_id, unnest(regexp_extract_all(array_to_string(ws, ''), '(?i){pattern}')) AS raw,
    generate_subscripts(regexp_extract_all(array_to_string(ws, ''), '(?i){pattern}'), 1) AS n FROM ws),
hits AS (SELECT doc_id, n, trim(replace(raw, '  ', ' ')) AS entity FROM found),
named AS (SELECT hits.*, label FROM hits JOIN gaz ON gaz.phrase = lower(entity))"""


KEPT = [g for g in sample.GAZETTEER if g[1] in fixed.KEPT_ENTITY_LABELS]
ENTITIES = matched(KEPT)


def domain(labels: list[str], threshold: float) -> str:
    return matched([g for g in sample.DOMAIN_GAZETTEER if g[1] in labels and g[2] >= threshold])


DOMAIN_COUNTS = "SELECT lower(entity) AS entity, label, count(*) AS count FROM named GROUP BY ALL"
ASPECTS = f"""{VALENCES}, {rows("asp", "word", sample.ASPECTS)},
pw AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}'']+') AS ws FROM documents)),
men AS (SELECT a.doc_id, a.pos, a.word AS aspect, round(sum(CAST(v.valence AS DOUBLE)), 9) AS s
  FROM pw a JOIN asp USING (word) JOIN (SELECT doc_id, pos, valence FROM pw JOIN val USING (word)) v
    ON v.doc_id = a.doc_id AND v.pos BETWEEN a.pos - 3 AND a.pos + 3 GROUP BY ALL),
mentions AS (SELECT doc_id, pos, aspect, CASE WHEN s > 0 THEN 'positive' ELSE 'negative' END AS polarity FROM men WHERE s <> 0),
acount AS (SELECT polarity, aspect, count(*) AS count FROM mentions GROUP BY ALL),
arank AS (SELECT *, row_number() OVER (PARTITION BY polarity ORDER BY count DESC, aspect) AS rank FROM acount)"""

# Per-comment keywords: a fold over the ranked candidates, each element a one-entry list.
KEYWORDS = f"""{TOKENS},
kt AS (SELECT doc_id, token AS term FROM tok UNION ALL
  SELECT a.doc_id, a.token || ' ' || b.token FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1),
ktf AS (SELECT doc_id, term, count(*) AS tf FROM kt GROUP BY ALL),
kdf AS (SELECT term, count(*) AS df FROM ktf GROUP BY term),
ks AS (SELECT doc_id, term, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS score
  FROM ktf JOIN kdf USING (term)),
kl AS (SELECT doc_id, list([term] ORDER BY score DESC, term) AS all_terms FROM ks GROUP BY doc_id),
kw AS (SELECT doc_id, list_reduce(all_terms, lambda kept, x: CASE WHEN len(kept) >= 8 OR len(list_filter(kept, lambda k:
    1 - levenshtein(k, x[1]) / greatest(length(k), length(x[1])) > 0.9)) > 0 THEN kept ELSE list_concat(kept, x) END)
  AS keywords FROM kl)"""
KEYWORD_LABELS = f"""{KEYWORDS},
top_docs AS (SELECT d.doc_id, e.label AS topic FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id),
tk AS (SELECT topic, unnest(keywords) AS word FROM top_docs JOIN kw USING (doc_id)),
tc AS (SELECT topic, word, count(*) AS c FROM tk GROUP BY ALL),
tr AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY c DESC, word) AS r FROM tc),
tl AS (SELECT topic, string_agg(word, ', ' ORDER BY r) AS label FROM tr WHERE r <= 5 GROUP BY topic),
labels5 AS (SELECT t.topic, coalesce(label, 'topic ' || t.topic) AS label
  FROM (SELECT DISTINCT topic FROM top_docs) t LEFT JOIN tl USING (topic))"""

# Tags

_SUFFIXES = " ".join(f"WHEN ends_with(word, {literal(e)}) THEN {literal(t)}" for e, t in fixed.SUFFIX_TAGS)
PATTERN_TAG = f"CASE {_SUFFIXES} WHEN regexp_matches(word, '^-?[0-9]+(.[0-9]+)?$') THEN 'CD' ELSE 'NN' END"
_CLOSED = " ".join(f"WHEN lower(word) IN {word_list(m)} THEN {literal(t)}" for t, m in fixed.CLOSED_CLASS.items())
DEFAULT_TAG = f"CASE WHEN word IN ('.', ',', '!', '?', ';', ':') THEN '.' {_CLOSED} ELSE {PATTERN_TAG} END"
TAG_PATTERN = r"[\p{L}\p{N}]+(?:''[\p{L}]+)?|[.,!?;:]"
TAGGED = f"""tw AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '{TAG_PATTERN}') AS ws FROM documents)),
tagged AS (SELECT *, {DEFAULT_TAG} AS tag FROM tw)"""
TRIPLES = f"""{TAGGED},
nodt AS (SELECT doc_id, word, tag, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS pos FROM tagged WHERE tag <> 'DT'),
tri AS (SELECT a.doc_id, a.pos, a.word AS subject, b.word AS verb, c.word AS object FROM nodt a
  JOIN nodt b ON b.doc_id = a.doc_id AND b.pos = a.pos + 1 JOIN nodt c ON c.doc_id = a.doc_id AND c.pos = a.pos + 2
  WHERE starts_with(a.tag, 'NN') AND starts_with(b.tag, 'VB') AND starts_with(c.tag, 'NN'))"""
EDGES = f"""{TRIPLES},
edges AS (SELECT lower(subject) AS subject, lower(verb) AS verb, lower(object) AS object, count(*) AS count FROM tri
  WHERE regexp_matches(subject, '^\\p{{L}}+$') AND regexp_matches(object, '^\\p{{L}}+$') GROUP BY ALL)"""
SENTENCES = r"""sents AS (SELECT doc_id, unnest(s) AS text, generate_subscripts(s, 1) - 1 AS no FROM (
  SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.?!])\s+', '\1' || chr(1), 'g'), chr(1)),
    lambda x: trim(x) <> '') AS s FROM documents))"""
TRAINING = f"""{SENTENCES},
sw AS (SELECT doc_id, no, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
  FROM (SELECT doc_id, no, regexp_extract_all(text, '{TAG_PATTERN}') AS ws FROM sents)),
st AS (SELECT *, {DEFAULT_TAG} AS tag FROM sw),
train AS (SELECT doc_id, no, pos, word, CASE WHEN lag(tag) OVER (PARTITION BY doc_id, no ORDER BY pos) = 'DT'
  AND starts_with(tag, 'VB') THEN 'NN' ELSE tag END AS tag FROM st)"""

# Languages

TRIGRAMS = r"""chars AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM documents),
tg AS (SELECT doc_id, lang, unnest(list_transform(range(1, greatest(length(w) - 1, 1)), lambda i: substr(w, i, 3))) AS g FROM chars),
cnt AS (SELECT lang, g, count(*) AS n FROM tg GROUP BY ALL),
lt AS (SELECT lang, sum(n) AS total FROM cnt GROUP BY lang),
prof AS (SELECT lt.lang AS guess, gs.g, ln((coalesce(cnt.n, 0) + 1) / (lt.total + (SELECT count(DISTINCT g) FROM cnt))) AS logp
  FROM lt CROSS JOIN (SELECT DISTINCT g FROM cnt) gs LEFT JOIN cnt ON cnt.lang = lt.lang AND cnt.g = gs.g),
sc AS (SELECT doc_id, guess, round(sum(logp * c), 6) AS s FROM (SELECT doc_id, g, count(*) AS c FROM tg GROUP BY ALL)
  JOIN prof USING (g) GROUP BY ALL),
bestl AS (SELECT doc_id, guess FROM sc QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, guess) = 1),
detected AS (SELECT d.doc_id, coalesce(guess, 'unknown') AS language FROM documents d LEFT JOIN bestl USING (doc_id))"""

# Spelling: all pairs whose lengths are close enough; the Spark job uses deletion variants. The distance function of
# the SQL engine counts bytes, so accented letters first become ASCII signs no word contains.
_ASCII = "translate({}, 'ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü', '0123456789!#$%&()*+,-')"
DICTIONARY = rf"""sw AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '\S+') AS ws FROM documents)),
alpha AS MATERIALIZED (SELECT word, {_ASCII.format("word")} AS a, length(word) AS len, count(*) AS freq FROM sw
  WHERE regexp_matches(word, '^\p{{L}}+$') GROUP BY word),
dict AS MATERIALIZED (SELECT word AS term, a AS b, freq, unnest(range(len - 2, len + 3)) AS len FROM alpha
  WHERE freq * 20000 >= (SELECT sum(freq) FROM alpha)),
close AS MATERIALIZED (SELECT word, alpha.freq AS rows, term, dict.freq, levenshtein(a, b) AS d
  FROM (SELECT * FROM alpha WHERE freq * 20000 < (SELECT sum(freq) FROM alpha)) alpha JOIN dict USING (len) WHERE levenshtein(a, b) <= 2),
fixes AS (SELECT word, rows, term FROM close QUALIFY row_number() OVER (PARTITION BY word ORDER BY d, freq DESC, term) = 1)"""

# Retrieval

QUESTIONS = """asked AS (SELECT e.label AS query_id, e.vec_id, e.embedding::DOUBLE[] AS q, d.text FROM embeddings e
  JOIN documents d ON d.doc_id = e.vec_id QUALIFY row_number() OVER (PARTITION BY e.label ORDER BY e.vec_id) = 1)"""


def nearest(name: str, queries: str, index: str, k: int) -> str:
    return f"""{name}_all AS (SELECT query_id, doc_id, round(power(list_distance(q, v), 2), 9) AS distance FROM {queries}, {index}),
{name} AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank, doc_id, distance
  FROM {name}_all QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) <= {k})"""


INDEX = "idx AS (SELECT vec_id AS doc_id, embedding::DOUBLE[] AS v, label FROM embeddings)"
DENSE = f"{QUESTIONS}, {INDEX}, {nearest('dense', 'asked', 'idx', 6)}"


def bm25(name: str, queries: str, k: int) -> str:
    """Ends in `name(query_id, rank, doc_id, score)`; `queries` has query_id and text."""
    return rf"""bt AS (SELECT doc_id, unnest(regexp_extract_all(text, '\S+')) AS term FROM documents),
btf AS (SELECT doc_id, term, count(*) AS tf FROM bt GROUP BY ALL),
blen AS (SELECT doc_id, sum(tf) AS length FROM btf GROUP BY doc_id),
bavg AS (SELECT count(*) AS n, avg(coalesce(length, 0)) AS mean FROM documents LEFT JOIN blen USING (doc_id)),
braw AS (SELECT term, ln((SELECT n FROM bavg) - count(*) + 0.5) - ln(count(*) + 0.5) AS idf FROM btf GROUP BY term),
bidf AS (SELECT term, CASE WHEN idf < 0 THEN 0.25 * (SELECT avg(idf) FROM braw) ELSE idf END AS idf FROM braw),
bq AS (SELECT query_id, unnest(regexp_extract_all(text, '\S+')) AS term FROM {queries}),
bqc AS (SELECT query_id, term, count(*) AS times FROM bq GROUP BY ALL),
bsc AS (SELECT query_id, doc_id, round(sum(times * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * length / (SELECT mean FROM bavg)))), 6) AS score
  FROM bqc JOIN bidf USING (term) JOIN btf USING (term) JOIN blen USING (doc_id) GROUP BY ALL),
{name} AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM bsc
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= {k})"""


CENTROIDS = """parts AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
centre AS (SELECT label AS query_id, list(m ORDER BY i) AS q FROM (SELECT label, i, avg(x) AS m FROM parts GROUP BY ALL) GROUP BY label)"""
RERANKED = f"""{QUESTIONS}, {INDEX}, {CENTROIDS}, {nearest('hits', 'asked', 'idx', 10)},
again AS (SELECT h.query_id, h.doc_id, h.rank AS rank_before, round(list_cosine_similarity(centre.q, idx.v), 6) AS score
  FROM hits h JOIN centre USING (query_id) JOIN idx USING (doc_id)),
rr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM again
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= 5)"""

# Reports

REPORT = f"""{RATED}, {ENTITIES}, {KEYWORDS},
sh AS (SELECT sentiment, round_even(100.0 * count(*) / (SELECT count(*) FROM rated), 1) AS p FROM rated GROUP BY sentiment),
tp AS (SELECT topic, count(*) AS c FROM rated WHERE topic <> -1 GROUP BY topic ORDER BY c DESC, topic LIMIT 8),
ec AS (SELECT entity, count(*) AS c FROM named GROUP BY entity ORDER BY c DESC, entity LIMIT 10),
kc AS (SELECT k, count(*) AS c FROM (SELECT unnest(keywords) AS k FROM kw) GROUP BY k ORDER BY c DESC, k LIMIT 10)"""
SENTIMENT_LINES = """SELECT 'sentiment' AS section, row_number() OVER (ORDER BY p DESC, sentiment) AS line_no,
  sentiment || ': ' || printf('%.1f', p) || '%' AS line FROM sh"""


def topic_lines(n: int) -> str:
    return f"""SELECT 'topics' AS section, row_number() OVER (ORDER BY c DESC, topic) AS line_no,
  'topic ' || topic || ' (' || c || ')' AS line FROM tp QUALIFY row_number() OVER (ORDER BY c DESC, topic) <= {n}"""


def routed() -> str:
    cases = " ".join(f"WHEN contains(lower(trim(text)), {literal(c)}) THEN {literal(c)}" for c in sample.ROUTE_CATEGORIES)
    return f"SELECT conv_id, turn, CASE {cases} ELSE 'qa' END AS category FROM conversations WHERE role = 'user'"


def classification(label: str, prediction: str, source: str) -> str:
    return f"""jd AS (SELECT {label}::VARCHAR AS y, {prediction}::VARCHAR AS p FROM {source}),
cls AS (SELECT y AS name FROM jd UNION SELECT p FROM jd),
cm AS (SELECT name, (SELECT count(*) FROM jd WHERE y = name) AS support, (SELECT count(*) FROM jd WHERE p = name) AS guessed,
    (SELECT count(*) FROM jd WHERE y = name AND p = name) AS hit FROM cls),
pr AS (SELECT name, CASE WHEN guessed = 0 THEN 0 ELSE hit / guessed END AS precision,
    CASE WHEN support = 0 THEN 0 ELSE hit / support END AS recall, support, hit FROM cm),
fr AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pr)
SELECT name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM fr
UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6),
  sum(support)::BIGINT FROM fr
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM fr
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM fr"""


HASHED = """hashed AS (SELECT *, ('0x' || substr(md5(doc_id || ':42'), 1, 12))::BIGINT AS h FROM {})"""

SQL: dict[str, str] = {
    "comment_table": f"""WITH {COMMENTS} SELECT doc_id, video_id, author, likes, {DAY.format("published_at")} AS published,
        length(text) AS n_chars FROM comments""",
    "comment_documents": f"""WITH {RATED} SELECT doc_id, text, '' AS comment_id, video_id, author, likes,
        strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, sentiment, topic, '' AS entities, '' AS keywords FROM rated""",
    "clean_comments": f"""WITH {UNIQUE_DOCS} SELECT u.doc_id,
        'c' || lpad((row_number() OVER (ORDER BY u.doc_id) - 1)::VARCHAR, 6, '0') AS comment_id,
        u.text, length(d.text) AS raw_chars FROM uniq u JOIN documents d USING (doc_id)""",
    "clean_pages": f"WITH {cleaned('pages', 'page_id', 'html')} SELECT page_id, t AS text FROM clean",
    "token_text": f"WITH {TOKENS} SELECT doc_id, len(toks) AS n_tokens, array_to_string(toks, ' ') AS text FROM arrays",
    "normalised_text": f"WITH {NORMALISED} SELECT doc_id, t AS text FROM norm",
    "text_measures": r"""SELECT doc_id, len(regexp_extract_all(text, '\S+')) AS n_words,
        len(regexp_extract_all(text, '[^.!?\s][^.!?]*')) AS n_sentences,
        coalesce(list_sum(list_transform(regexp_extract_all(lower(text), '\S+'),
            lambda w: greatest(len(regexp_extract_all(w, '[aeiouy]+')), 1))), 0)::BIGINT AS n_syllables,
        length(text) AS n_chars, substr(text, 1, 80) AS preview FROM documents""",
    "stop_word_union": f"WITH {TOKENS} SELECT doc_id, count(*) AS n_tokens FROM tok GROUP BY doc_id",
    "attested_lemmas": f"""WITH {TOKENS}, cand AS ({union(*[
        f"SELECT token AS word, left(token, length(token) - {len(e)}) || {literal(r)} AS stem FROM vocab WHERE ends_with(token, {literal(e)})"
        for e, r in fixed.DETACHMENTS])})
        SELECT word, arg_min(stem, {{'n': length(stem), 's': stem}}) AS lemma FROM cand
        WHERE stem IN (SELECT token FROM vocab) AND length(stem) < length(word) GROUP BY word""",
    "distinct_texts": """SELECT min(doc_id) AS doc_id, arg_min(source, doc_id) AS video_id, text FROM documents GROUP BY text""",
    "stream_ingest": f"WITH {UNIQUE_DOCS} SELECT u.doc_id, d.source, d.lang, u.text FROM uniq u JOIN documents d USING (doc_id)",
    "metadata_csv_round_trip": f"""WITH {COMMENTS} SELECT video_id, author, text, likes, {DAY.format("published_at")} AS published
        FROM comments""",
    "browse_filtered": f"""WITH {RATED} SELECT doc_id, author, text, sentiment, likes, {DAY.format("published_at")} AS published_at, topic
        FROM rated WHERE (regexp_matches(text, '(?i)idiot|worthless|customer#0000001')
          OR regexp_matches(coalesce(author, ''), '(?i)idiot|worthless|customer#0000001'))
        AND sentiment IN ('positive', 'negative') AND likes >= 50
        AND published_at BETWEEN TIMESTAMP '1993-01-01' AND TIMESTAMP '1998-01-01'""",
    "browse_longest": f"""WITH {COMMENTS} SELECT doc_id, length(text) AS n_chars, likes FROM comments
        ORDER BY length(text) DESC, doc_id LIMIT 50""",
    "browse_newest": f"""WITH {COMMENTS} SELECT doc_id, {DAY.format("published_at")} AS published FROM comments
        ORDER BY published_at DESC NULLS LAST, doc_id LIMIT 50""",
    "browse_oldest": f"""WITH {COMMENTS} SELECT doc_id, {DAY.format("published_at")} AS published FROM comments
        ORDER BY published_at ASC NULLS LAST, doc_id LIMIT 50""",
    "browse_export": f"""WITH {RATED} SELECT doc_id, author, sentiment, likes, {DAY.format("published_at")} AS published_at
        FROM rated WHERE sentiment = 'negative' AND likes >= 100""",
    "enriched_round_trip": f"""WITH {COMMENTS}, {ENTITIES} SELECT c.doc_id, c.likes, {DAY.format("c.published_at")} AS published,
        coalesce(string_agg(entity, '|' ORDER BY n), '') AS entities
        FROM comments c LEFT JOIN named USING (doc_id) GROUP BY ALL""",
    "scope_first": "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 500",
    "scope_most_liked": f"WITH {COMMENTS} SELECT doc_id, likes FROM comments ORDER BY likes DESC, doc_id LIMIT 500",
    "scope_newest": f"""WITH {COMMENTS} SELECT doc_id, {DAY.format("published_at")} AS published FROM comments
        ORDER BY published_at DESC, doc_id LIMIT 500""",
    "scope_random": f"WITH {HASHED.format('documents')} SELECT doc_id, text FROM hashed ORDER BY h, doc_id LIMIT 200",
    "overview_totals": rf"""WITH {COMMENTS} SELECT count(*) AS comments, sum(likes)::BIGINT AS likes,
        round(avg(len(regexp_extract_all(text, '\S+'))), 6) AS avg_words,
        round(avg(CASE WHEN contains(text, '?') THEN 1 ELSE 0 END), 6) AS question_share,
        {DAY.format("min(published_at)")} AS first_date, {DAY.format("max(published_at)")} AS last_date FROM comments""",
    "question_share": """SELECT count(*) AS comments, coalesce(avg(CASE WHEN contains(text, '?') THEN 1.0 ELSE 0.0 END), 0)
        AS question_share FROM documents""",
    "questions": "SELECT doc_id, text FROM documents WHERE contains(text, '?')",
    "sentiment_counts": f"WITH {POLARITY} SELECT sentiment, count(*) AS count FROM labelled GROUP BY sentiment",
    "sentiment_percentages": f"""WITH {POLARITY} SELECT sentiment,
        round_even(100.0 * count(*) / (SELECT count(*) FROM labelled), 1) AS percent FROM labelled GROUP BY sentiment""",
    "sentiment_mood": f"""WITH {POLARITY}, sh AS (SELECT 100.0 * avg((sentiment = 'positive')::INT) AS positive,
        100.0 * avg((sentiment = 'negative')::INT) AS negative FROM labelled)
        SELECT round(positive, 6) AS positive, round(negative, 6) AS negative, CASE WHEN positive > 60 THEN 'overwhelmingly positive'
        WHEN positive > negative THEN 'mostly positive' WHEN negative > positive THEN 'mostly negative' ELSE 'mixed' END AS mood FROM sh""",
    "monthly_sentiment": f"""WITH {RATED} SELECT strftime(published_at, '%Y-%m') AS month, sentiment, count(*) AS count
        FROM rated GROUP BY ALL""",
    "length_histogram": r"""WITH l AS (SELECT len(regexp_extract_all(text, '\S+'))::DOUBLE AS w FROM documents),
        b AS (SELECT min(w) AS lo, greatest((max(w) - min(w)) / 40, 1e-9) AS wd FROM l)
        SELECT least(floor((w - lo) / wd), 39)::INT AS bin, round(any_value(lo) + least(floor((w - lo) / wd), 39) * any_value(wd), 6) AS bin_start,
        count(*) AS count FROM l, b GROUP BY least(floor((w - lo) / wd), 39)""",
    "readability": r"""WITH m AS (SELECT sum(len(regexp_extract_all(text, '\S+')))::BIGINT AS words,
        sum(len(regexp_extract_all(text, '[^.!?\s][^.!?]*')))::BIGINT AS sentences,
        sum(coalesce(list_sum(list_transform(regexp_extract_all(lower(text), '\S+'),
            lambda w: greatest(len(regexp_extract_all(w, '[aeiouy]+')), 1))), 0))::BIGINT AS syllables FROM documents)
        SELECT words, sentences, syllables,
        round(206.835 - 1.015 * (words / sentences) - 84.6 * (syllables / words), 6) AS reading_ease,
        round(0.39 * (words / sentences) + 11.8 * (syllables / words) - 15.59, 6) AS grade_level FROM m""",
    "top_topics": """SELECT label AS topic, count(*) AS count FROM documents JOIN embeddings ON vec_id = doc_id
        GROUP BY label ORDER BY count DESC, topic LIMIT 10""",
    "topic_sentiment": f"""WITH {RATED}, big AS (SELECT topic FROM rated WHERE topic <> -1 GROUP BY topic ORDER BY count(*) DESC, topic LIMIT 8)
        SELECT topic, sentiment, count(*) AS count FROM rated WHERE topic IN (SELECT topic FROM big) GROUP BY ALL""",
    "strongest_topic_sentiment": f"""WITH {RATED}, big AS (SELECT topic FROM rated WHERE topic <> -1 GROUP BY topic ORDER BY count(*) DESC, topic LIMIT 8)
        SELECT topic, sentiment, count(*) AS count FROM rated WHERE topic IN (SELECT topic FROM big) GROUP BY ALL
        ORDER BY count DESC, topic, sentiment LIMIT 1""",
    "distinct_sentiments": f"WITH {POLARITY} SELECT DISTINCT sentiment FROM labelled",
    "distinct_languages": 'SELECT count(DISTINCT lang) AS "values" FROM documents',
    "subjective_share": f"WITH {POLARITY} SELECT round(100.0 * avg((subjectivity > 0.5)::INT), 6) AS subjective_percent FROM labelled",
    "first_comments_joined": """SELECT string_agg(text, chr(10) ORDER BY doc_id) AS text
        FROM (SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 20)""",
    "word_frequencies": f"WITH {TOKENS} SELECT token, n AS count FROM vocab ORDER BY n DESC, token LIMIT 30",
    "cloud_weights": f"""WITH {TOKENS} SELECT token, n AS count, round(n / (SELECT max(n) FROM vocab), 6) AS weight FROM vocab
        ORDER BY n DESC, token LIMIT 120""",
    "top_bigrams": f"WITH {TOKENS}, {GRAMS2} {TOP_GRAMS}",
    "top_trigrams": f"WITH {TOKENS}, {GRAMS3} {TOP_GRAMS}",
    "top_bigrams_spanning": f"WITH {TOKENS}, {SPAN2} {TOP_GRAMS}",
    "top_trigrams_spanning": f"WITH {TOKENS}, {SPAN3} {TOP_GRAMS}",
    "bigram_collocations": f"WITH {TOKENS}, {GRAMS2} {pmi(2)}",
    "trigram_collocations": f"WITH {TOKENS}, {GRAMS3} {pmi(3)}",
    "bigram_collocations_spanning": f"WITH {TOKENS}, {SPAN2} {pmi(2)}",
    "emoji_counts": """WITH found AS (SELECT unnest(regexp_extract_all(replace(html, '&copy;', '©'),
        '[\\x{A9}\\x{AE}\\x{2600}-\\x{27BF}\\x{1F000}-\\x{1FAFF}]')) AS emoji FROM pages)
        SELECT emoji, count(*) AS count FROM found GROUP BY emoji ORDER BY count DESC, emoji LIMIT 20""".replace("\\\\", "\\"),
    "distinctive_terms": distinctive("", "documents", "lang"),
    "distinctive_terms_by_sentiment": distinctive(f"{POLARITY}, ", "labelled", "sentiment"),
    "rule_sentiment": f"""WITH {RULES} SELECT doc_id, CASE WHEN sentiment_score >= 0.05 THEN 'positive'
        WHEN sentiment_score <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment, sentiment_score FROM rule""",
    "polarity_sentiment": f"WITH {POLARITY} SELECT doc_id, sentiment, round(polarity, 6) AS sentiment_score FROM labelled",
    "polarity_subjectivity": f"""WITH {POLARITY} SELECT doc_id, round(polarity, 6) AS polarity, round(subjectivity, 6) AS subjectivity
        FROM labelled""",
    "emotion_totals": f"""WITH {EMOTIONS}, {WORDS}, {rows("spine", "emotion", [(e,) for e in fixed.EMOTIONS])}
        SELECT emotion, count(word) AS count FROM spine LEFT JOIN (SELECT emotion, word FROM words JOIN emo USING (word)) h USING (emotion)
        GROUP BY emotion""",
    "leading_emotion": f"""WITH {EMOTIONS}, {WORDS} SELECT emotion, count(*) AS count FROM words JOIN emo USING (word)
        GROUP BY emotion ORDER BY count DESC, emotion LIMIT 1""",
    "top_emotion_comments": f"""WITH {EMOTIONS}, {WORDS}, s AS (SELECT doc_id, round(round(avg((emotion = 'trust')::INT), 9), 3) AS intensity
        FROM words JOIN emo USING (word) GROUP BY doc_id HAVING avg((emotion = 'trust')::INT) > 0
        ORDER BY intensity DESC, doc_id LIMIT 10) SELECT doc_id, text, intensity FROM s JOIN documents USING (doc_id)""",
    "named_entities": f"""WITH {ENTITIES} SELECT d.doc_id, coalesce(string_agg(entity, '|' ORDER BY n), '') AS entities,
        coalesce(string_agg(entity || ':' || label, '|' ORDER BY n), '') AS entity_labels
        FROM documents d LEFT JOIN named USING (doc_id) GROUP BY d.doc_id""",
    "entity_counts": f"""WITH {ENTITIES} SELECT entity AS entities, count(*) AS count FROM named GROUP BY entity
        ORDER BY count DESC, entity LIMIT 20""",
    "domain_entities": f"WITH {domain(fixed.DOMAIN_LABELS, 0.4)} {DOMAIN_COUNTS}",
    "domain_entities_chosen_labels": f"WITH {domain(['platform', 'price', 'character name'], 0.5)} {DOMAIN_COUNTS}",
    "leading_domain_entity": f"WITH {domain(fixed.DOMAIN_LABELS, 0.4)} {DOMAIN_COUNTS} ORDER BY count DESC, entity, label LIMIT 1",
    "aspect_mentions": f"WITH {ASPECTS} SELECT * FROM mentions",
    "aspect_polarity_counts": f"WITH {ASPECTS} SELECT polarity, aspect, count, rank FROM arank WHERE rank <= 10",
    "aspect_cloud_weights": f"""WITH {ASPECTS} SELECT polarity, aspect, count, rank,
        round(count / max(count) OVER (PARTITION BY polarity), 6) AS weight FROM arank WHERE rank <= 80""",
    "comment_keywords": f"""WITH {KEYWORDS} SELECT d.doc_id, coalesce(array_to_string(keywords, '|'), '') AS keywords
        FROM documents d LEFT JOIN kw USING (doc_id)""",
    "keyword_counts": f"""WITH {KEYWORDS} SELECT keywords, count(*) AS count FROM (SELECT unnest(keywords) AS keywords FROM kw)
        GROUP BY keywords ORDER BY count DESC, keywords LIMIT 20""",
    "topic_labels": f"WITH {KEYWORD_LABELS} SELECT topic, label FROM labels5",
    "top_topics_labelled": f"""WITH {KEYWORD_LABELS} SELECT topic, count(*) AS count, any_value(label) AS keywords FROM top_docs
        JOIN labels5 USING (topic) GROUP BY topic ORDER BY count DESC, topic LIMIT 10""",
    "tag_distribution": f"WITH {TAGGED} SELECT tag, count(*) AS count FROM tagged GROUP BY tag",
    "pattern_tags": f"WITH {TAGGED} SELECT {PATTERN_TAG} AS tag, count(*) AS count FROM tw GROUP BY ALL",
    "unigram_tags": f"""WITH {TRAINING}, c AS (SELECT word, tag, count(*) AS n FROM train GROUP BY ALL)
        SELECT word, tag FROM c QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, tag) = 1""",
    "noun_chunks": f"""WITH {TAGGED}, runs AS (SELECT doc_id, word, pos,
        pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM tagged WHERE starts_with(tag, 'NN')),
        ch AS (SELECT doc_id, min(pos) AS place, string_agg(word, ' ' ORDER BY pos) AS chunk FROM runs GROUP BY doc_id, run HAVING count(*) >= 2)
        SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS chunk_no, chunk FROM ch""",
    "relation_triples": f"""WITH {TRIPLES} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS triple_no,
        subject, verb, object FROM tri""",
    "distinct_relations": f"""WITH {TRIPLES}, n AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS triple_no,
        verb || '(' || subject || ', ' || object || ')' AS relation FROM tri)
        SELECT relation, doc_id, triple_no FROM n QUALIFY row_number() OVER (PARTITION BY relation ORDER BY doc_id, triple_no) = 1""",
    "knowledge_graph_edges": f"WITH {EDGES} SELECT * FROM edges ORDER BY count DESC, subject, verb, object LIMIT 30",
    "knowledge_graph_dot": f"""WITH {EDGES}, t AS (SELECT * FROM edges ORDER BY count DESC, subject, verb, object LIMIT 25)
        SELECT 'digraph KG {{' || chr(10) || '  rankdir=LR; node [shape=box, style=rounded];' || chr(10) ||
        string_agg('  "' || subject || '" -> "' || object || '" [label="' || verb || '"];', chr(10) ORDER BY count DESC, subject, verb, object)
        || chr(10) || '}}' AS dot FROM t""",
    "detected_languages": f"WITH {TRIGRAMS} SELECT doc_id, language FROM detected",
    "language_distribution": f"WITH {TRIGRAMS} SELECT language, count(*) AS count FROM detected GROUP BY language",
    "spelling_corrections": f"WITH {DICTIONARY} SELECT word, term, rows FROM fixes",
    "corrected_text": f"""WITH {DICTIONARY} SELECT d.doc_id, coalesce(string_agg(coalesce(term, word), ' ' ORDER BY pos), '') AS text
        FROM documents d LEFT JOIN sw USING (doc_id) LEFT JOIN fixes USING (word) GROUP BY d.doc_id""",
    "large_sentiment_groups": f"WITH {POLARITY} SELECT sentiment, count(*) AS count FROM labelled GROUP BY sentiment HAVING count(*) >= 50",
    "topic_words": f"""WITH src AS (SELECT d.text, e.label AS topic FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id),
        {terms("src", "topic")}, tf AS (SELECT label, term, count(*) AS tf FROM terms GROUP BY ALL),
        a AS (SELECT avg(s) AS a FROM (SELECT sum(tf) AS s FROM tf GROUP BY label)),
        s AS (SELECT label, term, round(tf * ln(1 + (SELECT a FROM a) / sum(tf) OVER (PARTITION BY term)), 6) AS score FROM tf)
        SELECT label AS topic, row_number() OVER (PARTITION BY label ORDER BY score DESC, term) AS rank, term, score FROM s
        QUALIFY row_number() OVER (PARTITION BY label ORDER BY score DESC, term) <= 8""",
    "topic_table": f"""WITH src AS (SELECT d.text, e.label AS topic FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id),
        {terms("src", "topic")}, tf AS (SELECT label, term, count(*) AS tf FROM terms GROUP BY ALL),
        a AS (SELECT avg(s) AS a FROM (SELECT sum(tf) AS s FROM tf GROUP BY label)),
        s AS (SELECT label, term, round(tf * ln(1 + (SELECT a FROM a) / sum(tf) OVER (PARTITION BY term)), 6) AS score FROM tf),
        r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, term) AS rank FROM s)
        SELECT topic, any_value(c) AS count, string_agg(term, ', ' ORDER BY rank) AS top_words
        FROM (SELECT topic, count(*) AS c FROM src GROUP BY topic) JOIN r ON r.label = topic WHERE rank <= 8 GROUP BY topic""",
    "stratified_split": f"""WITH lb AS (SELECT doc_id, quality::VARCHAR AS label FROM labels JOIN documents USING (doc_id)),
        {HASHED.format("lb")}, r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY h, doc_id) AS r,
        count(*) OVER (PARTITION BY label) AS n FROM hashed)
        SELECT doc_id, label, CASE WHEN r <= ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS part FROM r""",
    "toxicity_rule_report": f"""WITH {POLARITY}, src AS (SELECT toxic AS label, (sentiment = 'negative')::INT AS prediction
        FROM labelled JOIN labels USING (doc_id)), {classification("label", "prediction", "src")}""",
    "semantic_search": f"WITH {DENSE} SELECT query_id, rank, doc_id, round(distance, 6) AS distance FROM dense",
    "index_search": f"WITH {DENSE} SELECT query_id, rank, doc_id, round(distance, 6) AS distance FROM dense",
    "appended_index_search": f"WITH {DENSE} SELECT query_id, rank, doc_id, round(distance, 6) AS distance FROM dense",
    "approximate_search_bounds": f"WITH {DENSE} SELECT count(*) AS truth, true AS found_enough, true AS read_little FROM dense",
    "filtered_search": f"""WITH {POLARITY}, {QUESTIONS}, idx AS (SELECT vec_id AS doc_id, embedding::DOUBLE[] AS v FROM embeddings
        JOIN labelled ON doc_id = vec_id WHERE sentiment = 'negative'), {nearest("near", "asked", "idx", 5)}
        SELECT query_id, rank, doc_id, round(distance, 6) AS distance FROM near""",
    "indexed_search": f"""WITH {QUESTIONS}, idx AS (SELECT vec_id AS doc_id, embedding::DOUBLE[] AS v FROM embeddings
        JOIN documents ON doc_id = vec_id WHERE lang = 'en'), {nearest("near", "asked", "idx", 6)}
        SELECT query_id, rank, doc_id, round(distance, 6) AS distance FROM near""",
    "lexical_search": f"""WITH bench AS (SELECT item_id AS query_id, text FROM benchmark), {bm25("lex", "bench", 6)}
        SELECT query_id, rank, doc_id, round(score, 4) AS score FROM lex""",
    "term_index_search": f"""WITH bench AS (SELECT item_id AS query_id, text FROM benchmark), {bm25("lex", "bench", 6)}
        SELECT query_id, rank, doc_id, round(score, 4) AS score FROM lex""",
    "appended_term_index_search": f"""WITH bench AS (SELECT item_id AS query_id, text FROM benchmark), {bm25("lex", "bench", 6)}
        SELECT query_id, rank, doc_id, round(score, 4) AS score FROM lex""",
    "hybrid_search": f"""WITH {DENSE}, {bm25("lex", "asked", 6)},
        pool AS (SELECT query_id, doc_id, 0.5 / (60 + rank) AS part FROM dense UNION ALL
                 SELECT query_id, doc_id, 0.5 / (60 + rank) FROM lex),
        f AS (SELECT query_id, text, min(doc_id) AS doc_id, round(sum(part::DOUBLE), 9) AS score FROM pool JOIN documents USING (doc_id) GROUP BY ALL)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, doc_id, round(score, 6) AS score FROM f""",
    "reranked_search": f"WITH {RERANKED} SELECT query_id, rank, doc_id, score FROM rr",
    "rank_shift": f"""WITH {RERANKED} SELECT query_id, doc_id, rank AS rank_after, rank_before, rank_before - rank AS moved_up FROM rr""",
    "expanded_search": f"""WITH {QUESTIONS}, {INDEX}, {CENTROIDS}, {nearest("one", "asked", "idx", 6)}, {nearest("two", "centre", "idx", 6)},
        pool AS (SELECT query_id, 1 AS no, rank, doc_id FROM one UNION ALL SELECT query_id, 2, rank, doc_id FROM two),
        firsts AS (SELECT query_id, text, arg_min(doc_id, no * 1000 + rank) AS doc_id FROM pool JOIN documents USING (doc_id) GROUP BY ALL),
        s AS (SELECT f.query_id, f.doc_id, round(list_cosine_similarity(asked.q, idx.v), 6) AS score FROM firsts f
          JOIN asked USING (query_id) JOIN idx USING (doc_id))
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= 6""",
    "retrieval_quality": f"""WITH {DENSE}, ok AS (SELECT query_id, min(rank) AS r FROM dense JOIN documents USING (doc_id)
        WHERE {" OR ".join(f"contains(lower(text), {literal(w)})" for w in sample.EXPECTED_WORDS)} GROUP BY query_id)
        SELECT count(*) AS questions, round(avg((r IS NOT NULL)::INT), 6) AS hit_rate, round(avg(coalesce(1 / r, 0)), 6) AS mrr
        FROM asked LEFT JOIN ok USING (query_id)""",
    "answer_quality": r"""SELECT count(*) AS answers, round(avg(len(regexp_extract_all(text, '\S+'))), 6) AS avg_answer_words,
        round(avg(contains(text, '[')::INT), 6) AS groundedness FROM conversations WHERE role = 'assistant'""",
    "token_chunks": r"""WITH w AS (SELECT doc_id, regexp_extract_all(text, '\S+') AS t FROM documents),
        s AS (SELECT doc_id, t, unnest(range(0, greatest(len(t) - 10 - 1, 0) + 1, 90)) AS place FROM w WHERE len(t) > 0)
        SELECT doc_id, CAST(place / 90 AS INT) AS chunk_no, array_to_string(t[place + 1 : place + 100], ' ') AS chunk FROM s""",
    "recursive_chunks": r"""WITH p AS (SELECT doc_id, regexp_extract_all(text,
          '(?s).{1,225}\z|.{1,223}\n\n|.{1,224}\n|.{1,224} |.{1,225}') AS p FROM documents),
        u AS (SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM p),
        b AS (SELECT doc_id, i, piece, coalesce(regexp_extract(lag(piece) OVER (PARTITION BY doc_id ORDER BY i),
          '(?:^|\s)(\S(?s:.){0,24})\z', 1), '') AS before FROM u),
        c AS (SELECT doc_id, i, trim(before || piece, ' ') AS chunk FROM b)
        SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS chunk_no, chunk FROM c WHERE chunk <> ''""",
    "semantic_chunks": rf"""WITH {SENTENCES},
        bag AS (SELECT doc_id, no, text, list_distinct(regexp_extract_all(lower(text), '[\p{{L}}'']+')) AS b FROM sents),
        nx AS (SELECT *, lag(b) OVER (PARTITION BY doc_id ORDER BY no) AS a FROM bag),
        di AS (SELECT doc_id, no, text, CASE WHEN a IS NULL THEN NULL WHEN len(a) = 0 OR len(b) = 0 THEN 1.0::DOUBLE ELSE
          round(1 - len(list_intersect(a, b)) / sqrt(len(a)::DOUBLE * len(b)::DOUBLE), 9) END AS d FROM nx),
        th AS (SELECT doc_id, quantile_cont(d, 0.95) AS t FROM di GROUP BY doc_id),
        gr AS (SELECT doc_id, no, text, sum(CASE WHEN d > t THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY no) AS g
          FROM di JOIN th USING (doc_id))
        SELECT doc_id, g::INT AS chunk_no, string_agg(text, ' ' ORDER BY no) AS chunk FROM gr GROUP BY doc_id, g""",
    "rejoined_vector_chunks": f"WITH {SENTENCES} SELECT doc_id, string_agg(text, ' ' ORDER BY no) AS text FROM sents GROUP BY doc_id",
    "topic_cover": "SELECT count(*) AS documents, true AS numbered, true AS by_size FROM documents",
    "sentiment_insight": f"""WITH {POLARITY}, sh AS (SELECT sentiment,
        round_even(100.0 * count(*) / (SELECT count(*) FROM labelled), 1) AS p FROM labelled GROUP BY sentiment) {SENTIMENT_LINES}""",
    "topic_insight": f"""WITH tp AS (SELECT label AS topic, count(*) AS c FROM embeddings JOIN documents ON doc_id = vec_id GROUP BY label)
        {topic_lines(8)}""",
    "full_report": f"""WITH {REPORT}, a AS ({SENTIMENT_LINES}), b AS ({topic_lines(6)})
        SELECT 1 AS section_no, * FROM a UNION ALL SELECT 2, * FROM b
        UNION ALL SELECT 3, 'entities', row_number() OVER (ORDER BY c DESC, entity), entity FROM ec
        UNION ALL SELECT 4, 'keywords', row_number() OVER (ORDER BY c DESC, k), k FROM kc""",
    "summary_context": f"""WITH {RATED}, {QUESTIONS}, {INDEX}, {nearest("near", "asked", "idx", 12)}
        SELECT query_id, string_agg('[' || rank || '] (' || sentiment || ', likes=' || likes || ') ' || text, chr(10) || chr(10) ORDER BY rank) AS context
        FROM near JOIN rated USING (doc_id) GROUP BY query_id""",
    "routed_queries": f"""WITH r AS ({routed()}) SELECT *, CASE category WHEN 'sentiment' THEN 'sentiment_agent'
        WHEN 'summary' THEN 'summary_agent' WHEN 'topics' THEN 'topic_agent' ELSE 'qa_agent' END AS specialist FROM r""",
    "routed_query_counts": f"WITH r AS ({routed()}) SELECT category, count(*) AS count FROM r GROUP BY category",
    "enriched_fields": f"""WITH {UNIQUE_DOCS}, documents AS (SELECT doc_id, text FROM uniq), {RULES}, {ENTITIES}, {KEYWORDS},
        e AS (SELECT doc_id, string_agg(entity, '|' ORDER BY n) AS entities FROM named GROUP BY doc_id)
        SELECT 'c' || lpad((row_number() OVER (ORDER BY u.doc_id) - 1)::VARCHAR, 6, '0') AS comment_id, u.doc_id,
        CASE WHEN sentiment_score >= 0.05 THEN 'positive' WHEN sentiment_score <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment,
        sentiment_score, coalesce(entities, '') AS entities, coalesce(array_to_string(keywords, '|'), '') AS keywords
        FROM uniq u JOIN rule USING (doc_id) LEFT JOIN e USING (doc_id) LEFT JOIN kw USING (doc_id)""",
    "lemma_frequencies": "",
}
_LEMMAS = f"lem AS ({SQL['attested_lemmas'].split(f'WITH {TOKENS}, ')[1].join(['WITH ', ''])})"
# Every token replaced by its lemma, then counted like plain tokens.
LEMMA_TOKENS = f"""{TOKENS}, {_LEMMAS},
ltok AS (SELECT doc_id, pos, coalesce(lemma, token) AS token FROM tok LEFT JOIN lem ON lem.word = token),
lvocab AS (SELECT token, count(*) AS n FROM ltok GROUP BY token)"""


def on_lemmas(sql: str) -> str:
    return sql.replace("tok ", "ltok ").replace("vocab", "lvocab")


SQL["lemma_cloud_weights"] = f"""WITH {LEMMA_TOKENS} SELECT token, n AS count,
    round(n / (SELECT max(n) FROM lvocab), 6) AS weight FROM lvocab ORDER BY n DESC, token LIMIT 120"""
SQL["lemma_bigrams"] = f"WITH {LEMMA_TOKENS}, {on_lemmas(GRAMS2)} {TOP_GRAMS}"
SQL["lemma_trigrams"] = f"WITH {LEMMA_TOKENS}, {on_lemmas(GRAMS3)} {TOP_GRAMS}"
SQL["lemma_bigram_collocations"] = f"WITH {LEMMA_TOKENS}, {on_lemmas(GRAMS2)} {on_lemmas(pmi(2))}"
SQL["lemma_trigram_collocations"] = f"WITH {LEMMA_TOKENS}, {on_lemmas(GRAMS3)} {on_lemmas(pmi(3))}"
SQL["lemma_frequencies"] = (
    f"WITH {TOKENS}, {_LEMMAS}"
    " SELECT coalesce(lemma, token) AS token, sum(n)::BIGINT AS count FROM vocab LEFT JOIN lem ON lem.word = token"
    " GROUP BY 1 ORDER BY count DESC, 1 LIMIT 30"
)

SQL["lemmatised_token_text"] = f"""WITH {LEMMA_TOKENS},
    joined AS (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS text FROM ltok GROUP BY doc_id)
    SELECT doc_id, len(toks) AS n_tokens, coalesce(text, '') AS text FROM arrays LEFT JOIN joined USING (doc_id)"""

# Collector pages, metrics and stages
SQL["loaded_comments"] = SQL["metadata_csv_round_trip"]
SQL["flattened_pages"] = """SELECT source AS video_id, doc_id // 100 AS page_no,
    row_number() OVER (PARTITION BY source, doc_id // 100 ORDER BY doc_id) - 1 AS item_no,
    lang AS author, text, n_chars AS likes, source AS published_at FROM documents"""
SQL["collected_comments"] = f"""WITH flat AS ({SQL["flattened_pages"]}),
    pages AS (SELECT video_id, page_no, count(*) AS n FROM flat
      WHERE video_id IN (SELECT DISTINCT source FROM documents ORDER BY source LIMIT 3) GROUP BY ALL),
    kept AS (SELECT * FROM pages QUALIFY coalesce(sum(n) OVER (ORDER BY video_id, page_no
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 300)
    SELECT video_id, author, text, likes, published_at FROM flat JOIN kept USING (video_id, page_no)
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY video_id, page_no, item_no) = 1"""
SQL["replayed_pages"] = SQL["collected_comments"].split("SELECT video_id, author")[0] + """
    SELECT video_id, dense_rank() OVER (PARTITION BY video_id ORDER BY page_no) - 1 AS page_no, item_no, author, text, likes, published_at
    FROM flat JOIN kept USING (video_id, page_no)"""
SQL["metrics_log"] = """WITH runs AS (SELECT 'all' AS run_name, * FROM documents
      UNION ALL SELECT 'english', * FROM documents WHERE lang = 'en'),
    found AS (SELECT run_name, count(*)::DOUBLE AS documents, avg(n_chars) AS mean_chars FROM runs GROUP BY run_name)
    SELECT run_name, 'documents' AS key, documents AS value, run_name AS lang FROM found
    UNION ALL SELECT run_name, 'mean_chars', round(mean_chars, 6), run_name FROM found"""
SQL["built_stages"] = """SELECT lang, count(*) AS n, 'kept' AS stage FROM documents GROUP BY lang
    UNION ALL SELECT lang, sum(n_chars)::BIGINT, 'rebuilt' FROM documents GROUP BY lang"""

# Greedy choice of diverse hits: per step the candidate of the best balance between the question and what is chosen.
_UNIT = "list_transform({0}, lambda x: x / sqrt(list_dot_product({0}, {0})))"


def diverse(name: str, k: int) -> str:
    """Ends in `name(query_id, rank, doc_id)`, needs asked and idx."""
    return f"""{nearest('pool', 'asked', 'idx', 20)},
    cand AS (SELECT p.query_id, p.rank, p.doc_id, {_UNIT.format("v")} AS u, list_dot_product({_UNIT.format("q")}, {_UNIT.format("v")}) AS near
      FROM pool p JOIN idx USING (doc_id) JOIN asked USING (query_id)),
    greedy AS (
      SELECT query_id, 0 AS rank, NULL::BIGINT AS doc_id, []::BIGINT[] AS chosen, []::DOUBLE[][] AS us FROM asked
      UNION ALL
      SELECT g.query_id, g.rank + 1, c.doc_id, list_append(g.chosen, c.doc_id), list_append(g.us, c.u)
      FROM greedy g JOIN cand c ON c.query_id = g.query_id AND NOT list_contains(g.chosen, c.doc_id)
      WHERE g.rank < {k}
      QUALIFY row_number() OVER (PARTITION BY g.query_id ORDER BY round(CASE WHEN g.rank = 0 THEN c.near
        ELSE 0.5 * c.near - 0.5 * list_max(list_transform(g.us, lambda x: list_dot_product(x, c.u))) END, 9) DESC, c.rank) = 1),
    {name} AS (SELECT query_id, rank, doc_id FROM greedy WHERE rank > 0)"""


SQL["diverse_search"] = f"WITH RECURSIVE {QUESTIONS}, {INDEX}, {diverse('div', 6)} SELECT * FROM div"
_FOUR = f"{QUESTIONS}, {INDEX}, {nearest('dense', 'asked', 'idx', 4)}, {bm25('lex', 'asked', 4)}, {diverse('div', 4)}"
_ROWS = """SELECT 'semantic' AS strategy, query_id, rank, doc_id FROM dense UNION ALL SELECT 'lexical', query_id, rank, doc_id FROM lex
    UNION ALL SELECT 'diverse', query_id, rank, doc_id FROM div"""
SQL["strategy_rows"] = f"WITH RECURSIVE {_FOUR} {_ROWS}"
SQL["strategy_overlap"] = f"""WITH RECURSIVE {_FOUR},
    pool2 AS (SELECT query_id, doc_id, 0.5 / (60 + rank) AS part FROM dense UNION ALL SELECT query_id, doc_id, 0.5 / (60 + rank) FROM lex),
    hyb AS (SELECT query_id, text, min(doc_id) AS doc_id FROM pool2 JOIN documents USING (doc_id) GROUP BY ALL),
    found AS (SELECT DISTINCT strategy, query_id, doc_id FROM ({_ROWS} UNION ALL SELECT 'hybrid', query_id, 0, doc_id FROM hyb))
    SELECT a.strategy AS first, b.strategy AS second, count(*) AS shared
    FROM found a JOIN found b USING (query_id, doc_id) GROUP BY ALL"""
SQL["retrieval_quality_per_question"] = rf"""WITH {DENSE},
    want AS (SELECT query_id, unnest(list_filter(regexp_extract_all(lower(text), '\p{{L}}+'), lambda w: length(w) >= 8)[1:3]) AS w FROM asked),
    ok AS (SELECT n.query_id, min(n.rank) AS r FROM dense n JOIN documents USING (doc_id) JOIN want USING (query_id)
      WHERE contains(lower(documents.text), w) GROUP BY n.query_id)
    SELECT count(*) AS questions, round(avg((r IS NOT NULL)::INT), 6) AS hit_rate, round(avg(coalesce(1 / r, 0)), 6) AS mrr
    FROM asked LEFT JOIN ok USING (query_id)"""

"""The registered queries in SQL, for a check on another engine (RE2 expressions)."""

from moodwell.functions import emotion_words
from moodwell.functions.emotions import default_lexicon
from moodwell.functions.language import BUCKETS, MIXED_FROM, PART_MARGIN, PART_PAIRS
from moodwell.functions.rules import ENTITIES, NOISE_TAGS, SHORT_WORDS
from moodwell.functions.symbols import EMOJI_NAMES, unlisted_symbols
from moodwell.operators.ingest import SIMPLE_EMOJI
from moodwell.plans.testviews import CLEANED_SQL, ENRICHED_SQL, RAW_SQL
from moodwell.schemas import EMOTIONS

SPACE = r"[\s\x0b\p{Z}\x1c-\x1f\x{85}]"
SOLID = r"[^\s\x0b\p{Z}\x1c-\x1f\x{85}]"
WORD = r"[\p{L}\p{N}_]"
URL = rf"(?i)https?://{SOLID}+|www\.{SOLID}+"

# The symbols in the test tables that have no name of their own.
OTHER_SYMBOLS = {"🚗": "automobile", "©": "copyright_sign", "°": "degree_sign"}

RAW = f"raw_posts AS ({RAW_SQL})"
CLEANED = f"cleaned_posts AS ({CLEANED_SQL})"
ENRICHED = f"enriched_posts AS ({ENRICHED_SQL})"
TEXTS = f"""{RAW},
texts AS (SELECT 'post' AS origin, id, raw_text AS text FROM raw_posts
 UNION ALL SELECT 'page', page_id, html FROM pages
 UNION ALL SELECT 'turn', conv_id * 1000 + turn, text FROM conversations)"""
JOINED = f"""{RAW}, {CLEANED}, {ENRICHED},
joined AS (SELECT r.id AS raw_post_id, r.batch_id, r.raw_text, r.keyword, c.cleaned_text, c.language,
  e.emotion_label, e.confidence, e.analyzed_at
 FROM raw_posts r
 LEFT JOIN cleaned_posts c ON c.raw_post_id = r.id AND c.batch_id = r.batch_id
 LEFT JOIN enriched_posts e ON e.cleaned_post_id = c.id AND e.batch_id = c.batch_id)"""
COMMENTS = r"""comments AS (SELECT
 CASE WHEN doc_id % 3 = 0 THEN '  ' || upper(lang) ELSE lang END AS device,
 doc_id AS comment_id,
 CASE WHEN n_chars % 40 = 0 THEN '' ELSE ' ' || text || ' ' || chr(10) END AS comment
 FROM documents)"""


def listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def gsub(text: str, pattern: str, new: str = "") -> str:
    return f"regexp_replace({text}, '{pattern}', '{new}', 'g')"


def strip(text: str) -> str:
    return gsub(text, rf"\A{SPACE}+|{SPACE}+\z")


def name_symbols(text: str) -> str:
    """Nested replacements, two-character emoji first."""
    names = {**EMOJI_NAMES, **OTHER_SYMBOLS}
    out = f"nfc_normalize({text})"
    for emoji in sorted(names, key=len, reverse=True):
        out = f"replace({out}, '{emoji}', '_{names[emoji]}_ ')"
    return out


def hashtags(text: str) -> str:
    tag = "substr(p, 2)"
    opened = f"regexp_replace({tag}, '([a-z])([A-Z])', '\\1 \\2', 'g')"
    return f"""array_to_string(list_transform(regexp_extract_all({text}, '#{WORD}+|[^#]+|#'), lambda p:
 CASE WHEN NOT regexp_full_match(p, '#{WORD}+') THEN p
 WHEN lower({tag}) IN ({listed(NOISE_TAGS)}) THEN '' ELSE {opened} END), '')"""


def noise_hashtags(text: str) -> str:
    return f"""array_to_string(list_transform(regexp_extract_all({text}, '#{WORD}+|[^#]+|#'), lambda p:
 CASE WHEN regexp_full_match(p, '#{WORD}+') AND lower(substr(p, 2)) IN ({listed(NOISE_TAGS)})
 THEN '' ELSE p END), '')"""


def entities(text: str) -> str:
    for entity, plain in ENTITIES.items():
        quoted = plain.replace("'", "''")
        text = f"replace({text}, '{entity}', '{quoted}')"
    return text


def punct(text: str) -> str:
    return gsub(gsub(gsub(text, "!{2,}", "!"), r"\?{2,}", "?"), r"\.{4,}", "...")


def separators(text: str) -> str:
    return gsub(text, "[-=*~_]{4,}")


def ascii_art(text: str) -> str:
    return gsub(text, r"[|/\\<>^]{3,}")


def whitespace(text: str) -> str:
    return strip(gsub(text, r"[ \t\n]+", " "))


def letters(text: str) -> str:
    return f"length({gsub(text, '[^\\p{L}]+')})"


def capitals(text: str) -> str:
    return f"length({gsub(text, '[^\\p{Lu}]+')})"


def tokens(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{SPACE}+'), lambda w: w <> '')"


def words(text: str) -> str:
    return rf"len(list_filter({tokens(text)}, lambda w: regexp_matches(w, '\p{{L}}')))"


def noise(text: str) -> str:
    short = f"length(w) <= 2 AND lower(w) NOT IN ({listed(SHORT_WORDS)})"
    return f"len(list_filter({tokens(text)}, lambda w: {short}))"


def latin(text: str) -> str:
    share = f"length({gsub(text, '[^\\p{Latin}]+')}) / {letters(text)}"
    return f"(CASE WHEN {letters(text)} = 0 THEN true ELSE {share} > 0.5e0 END)"


def all_caps(text: str) -> str:
    share = f"{capitals(text)} / {letters(text)}"
    return f"(CASE WHEN {letters(text)} = 0 THEN false ELSE {share} > 0.7e0 END)"


def gibberish(text: str) -> str:
    few = f"length({text}) > 5 AND {letters(text)} / length({text}) < 0.3e0"
    noisy = f"len({tokens(text)}) >= 3 AND {noise(text)} / len({tokens(text)}) > 0.7e0"
    return f"({text} = '' OR ({few}) OR ({noisy}))"


def pairs(name: str, source: str, key: str, text: str) -> str:
    """Relation of ``key`` and the bucket of each pair of neighbouring letters."""
    chars = f"string_split({gsub(f'lower({text})', '[^\\p{L}]+', ' ')}, '')"
    return f"""{name}_chars AS (SELECT {key}, {chars} AS ch FROM {source}),
{name} AS (SELECT {key}, (unicode(z[1]) * 257 + unicode(z[2])) % {BUCKETS} AS bucket, z[3] AS place
 FROM (SELECT {key}, unnest(list_zip(ch[1:len(ch) - 1], ch[2:len(ch)], range(len(ch) - 1))) AS z
  FROM {name}_chars WHERE len(ch) >= 2))"""


COST = f"CAST(round(-1000 * ln((n + 1) / (total + {BUCKETS}))) AS BIGINT)"

def profile(source: str) -> str:
    """Relation ``profile``: what the rows of ``source`` with their ``lang`` teach."""
    return f"""{pairs('train', source, 'lang', 'text')},
seen AS (SELECT lang, bucket, count(*) AS n FROM train GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS total FROM seen GROUP BY ALL),
profile AS (SELECT lang, b.bucket, {COST} AS cost
 FROM (SELECT lang, total, coalesce(n, 0) AS n, g.bucket
  FROM totals CROSS JOIN (SELECT unnest(range({BUCKETS})) AS bucket) g
  LEFT JOIN seen USING (lang, bucket)) b)"""


PROFILE = profile("documents")


def ranked(source: str, key: str, text: str) -> str:
    """Costs per key and language, then language, cost of a pair and the mixed flag per key."""
    return f"""{pairs('found', source, key, text)},
sized AS (SELECT {key}, count(*) AS held FROM found GROUP BY ALL),
part_costs AS (SELECT {key}, lang, least(place // {PART_PAIRS}, greatest(1, held // {PART_PAIRS}) - 1) AS part,
 CAST(sum(cost) AS BIGINT) AS cost, count(*) AS inside
 FROM found JOIN sized USING ({key}) JOIN profile USING (bucket) GROUP BY ALL),
costs AS (SELECT {key}, lang, CAST(sum(cost) AS BIGINT) AS cost FROM part_costs GROUP BY ALL),
places AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY cost, lang) AS place,
 min(cost) OVER (PARTITION BY {key}) AS best FROM costs),
wins AS (SELECT *, row_number() OVER (PARTITION BY {key}, part ORDER BY cost, lang) AS part_place FROM part_costs),
others AS (SELECT {key}, w.lang, sum(w.inside) AS inside FROM wins w JOIN places p USING ({key})
 JOIN part_costs c USING ({key}, part) WHERE part_place = 1 AND p.place = 1 AND c.lang = p.lang
 AND c.cost - w.cost > {PART_MARGIN} GROUP BY ALL),
most AS (SELECT {key}, max(inside) AS other FROM others GROUP BY ALL),
detected AS (SELECT {key}, max(CASE WHEN place = 1 THEN lang END) AS language,
 any_value(best // held) AS pair_cost,
 sum(CASE WHEN place = 2 THEN exp((best - cost) / 1000e0) END) / sum(exp((best - cost) / 1000e0))
 > {MIXED_FROM}e0 OR coalesce(any_value(other) / any_value(held), 0) > {MIXED_FROM}e0 AS mixed_language
 FROM places JOIN sized USING ({key}) LEFT JOIN most USING ({key}) GROUP BY {key})"""


def cleaning(source: str, text: str, detect: str = "") -> str:
    """Relation ``cleaned`` of the source with the results of all rules.

    ``detect`` names the key to detect the language by; without it all is English.
    """
    steps = f"""s0 AS (SELECT *, CASE WHEN regexp_matches({text}, '{SOLID}') THEN {text} END AS x FROM {source}),
s1 AS (SELECT *, nfc_normalize(x) AS t0, {name_symbols('x')} AS t1 FROM s0),
s2 AS (SELECT *, {gsub('t1', URL)} AS t2 FROM s1),
s3 AS (SELECT *, {gsub('t2', f'@{WORD}+')} AS t3 FROM s2),
s4 AS (SELECT *, {hashtags('t3')} AS t4 FROM s3),
s5 AS (SELECT *, {entities('t4')} AS t5 FROM s4),
s6 AS (SELECT *, {whitespace(punct(ascii_art(separators('t5'))))} AS t6 FROM s5),
s7 AS (SELECT *, CASE WHEN t6 IS NULL OR {words('t6')} < 3 THEN 'too_short'
 WHEN {gibberish('t6')} THEN 'gibberish' WHEN NOT {latin('t6')} THEN 'non_latin_script'
 ELSE 'ok' END AS status FROM s6)"""
    found = ""
    if detect:
        plain = gsub("t6", f"_{WORD}+_")
        found = f", {PROFILE}, {ranked('s7', detect, plain)}"
    mixed = "coalesce(d.mixed_language, false)" if detect else "false"
    language = "coalesce(d.language, 'en')" if detect else "'en'"
    join = f"LEFT JOIN detected d USING ({detect})" if detect else ""
    flags = ", ".join(
        f"CASE WHEN {test} THEN '{flag}' END"
        for flag, test in {
            "had_emojis": "t1 <> t0",
            "had_urls": f"regexp_matches(t1, '{URL}')",
            "had_mentions": f"regexp_matches(t2, '@{WORD}')",
            "had_hashtags": f"regexp_matches(t3, '#{WORD}')",
            "encoding_issue": "t5 <> t4",
            "mixed_language": mixed,
            "all_caps": f"t6 IS NOT NULL AND {all_caps('t6')}",
        }.items()
    )
    return f"""{steps}{found},
cleaned AS (SELECT s7.*, {language} AS language,
 CASE WHEN status IN ('ok', 'non_latin_script') THEN t6 END AS cleaned_text,
 coalesce(t1 <> t0, false) AS emoji_converted,
 array_to_string(list_filter([{flags}], lambda f: f IS NOT NULL), ',') AS flags
 FROM s7 {join})"""


def rule(out: str) -> str:
    return f"""WITH {TEXTS} SELECT origin, id, {out} AS out, coalesce({out} <> text, false) AS hit
 FROM texts"""


LEXICON = default_lexicon()
SYMBOLS = "|".join(w for ws in LEXICON.values() for w in ws if w.startswith("_"))
KNOWN = listed(sorted({w for ws in LEXICON.values() for w in ws}))


def lexicon_score(source: str, key: str, text: str) -> str:
    """Relation ``labelled``: the seven scores, label and confidence per key."""
    parted = gsub(f"lower({text})", f"({SYMBOLS})", r" \1")
    hits = f"list_filter(regexp_extract_all({parted}, '{WORD}+'), lambda w: w IN ({KNOWN}))"
    scores = ", ".join(
        "CASE WHEN len(coalesce(hits, [])) = 0 THEN "
        + ("1e0" if e == "neutral" else "0e0")
        + " ELSE "
        + (
            f"round(len(list_filter(hits, lambda w: w IN ({listed(LEXICON[e])}))) / len(hits), 4)"
            if e in LEXICON
            else "0e0"
        )
        + f" END AS {e}"
        for e in EMOTIONS
    )
    return f"""hit AS (SELECT {key}, {hits} AS hits FROM {source}),
scored AS (SELECT {key}, {scores} FROM hit),
{labelled('scored')}"""


def emotion_costs() -> str:
    """Relations ``weak`` (the texts with a leading emotion), its hashed words ``hashed``, and ``model``."""
    leading = " + ".join(f"CAST({e} = confidence AS INT)" for e in EMOTIONS)
    weights = ", ".join(map(str, emotion_words.powers()))
    return f"""{lexicon_score('texts', 'origin, id, text', 'text')},
weak AS (SELECT origin, id, emotion_label AS label, text FROM labelled
 WHERE {leading} = 1 AND text IS NOT NULL),
worded AS (SELECT origin, id, label,
 unnest(string_split({gsub('lower(text)', r'[^\p{L}\p{N}_]+', ' ')}, ' ')) AS word FROM weak),
hashed AS (SELECT origin, id, label, list_sum(list_transform(range(length(word)),
 lambda i: unicode(substr(word, i + 1, 1)) * [{weights}][(i % {emotion_words.PLACES}) + 1]))
 % {emotion_words.BUCKETS} AS bucket FROM worded WHERE word <> ''),
learned AS (SELECT * FROM hashed WHERE id % 5 <> 4),
taught AS (SELECT label, count(*) AS texts FROM weak WHERE id % 5 <> 4 GROUP BY label),
sums AS (SELECT label, count(*) AS total FROM learned GROUP BY label),
counts AS (SELECT label, bucket, count(*) AS n FROM learned GROUP BY ALL),
model AS (SELECT label, CAST(round(-1000e0 * ln(texts / (SELECT sum(texts) FROM taught))) AS BIGINT) AS prior,
 CAST(g.bucket AS BIGINT) AS bucket,
 CAST(round(-1000e0 * ln((coalesce(n, 0) + 1) / (total + {emotion_words.BUCKETS}))) AS BIGINT) AS cost
 FROM sums JOIN taught USING (label) CROSS JOIN (SELECT unnest(range({emotion_words.BUCKETS})) AS bucket) g
 LEFT JOIN counts USING (label, bucket))"""


def labelled(source: str) -> str:
    best = f"greatest({', '.join(EMOTIONS)})"
    picks = " ".join(f"WHEN {e} = {best} THEN '{e}'" for e in EMOTIONS)
    return f"""labelled AS (SELECT *, CASE {picks} END AS emotion_label, {best} AS confidence
 FROM {source})"""


MADE_UP = f"""made AS (SELECT *, round(CAST(doc_id % 97 AS DOUBLE) / 97, 4) AS joy,
 round(CAST(n_chars % 89 AS DOUBLE) / 89, 4) AS anger, round(CAST(doc_id % 7 AS DOUBLE) / 7, 4) AS fear,
 0e0 AS disgust, round(CAST(n_chars % 3 AS DOUBLE) / 3, 4) AS sadness, 0e0 AS surprise, 0e0 AS neutral
 FROM documents),
{labelled('made')}"""

SEVEN = ", ".join(EMOTIONS)
MOMENT = "'2024-05-01 12:00:00'"
UNANALYZED = """unanalyzed AS (SELECT c.* FROM cleaned_posts c WHERE NOT EXISTS (
 SELECT 1 FROM enriched_posts e WHERE e.cleaned_post_id = c.id))"""
FOUND = """found AS (SELECT * FROM raw_posts WHERE keyword ILIKE '%{0}%' OR raw_text ILIKE '%{0}%'),
newest AS (SELECT * FROM found ORDER BY created_at DESC NULLS FIRST, id DESC LIMIT {1})"""


def shorten(text: str, n: int) -> str:
    value = strip(f"coalesce({text}, '')")
    cut = gsub(f"substring({value}, 1, {n - 3})", rf"{SPACE}+\z")
    return f"CASE WHEN length({value}) <= {n} THEN {value} ELSE {cut} || '...' END"


def counted(table: str) -> str:
    return f"SELECT '{table}' AS item, batch_id, count(*) AS posts FROM {table}_left GROUP BY ALL"


SHARES = "count(*) FILTER (lower(emotion_label) = '{0}')"
BY_EMOTION = " UNION ALL ".join(
    f"SELECT batch_id, {i} AS position, '{e.capitalize()}' AS emotion, "
    f"{SHARES.format(e)} AS posts FROM joined GROUP BY batch_id"
    for i, e in enumerate(EMOTIONS, 1)
)
KNOWN_LABELS = f"count(*) FILTER (lower(emotion_label) IN ({listed(EMOTIONS)}))"
BY_SHARE = " UNION ALL ".join(
    f"SELECT batch_id, '{e.capitalize()}' AS emotion, {SHARES.format(e)} AS posts, "
    f"coalesce(round({SHARES.format(e)} * 100e0 / nullif({KNOWN_LABELS}, 0), 4), 0) AS percent "
    "FROM joined GROUP BY batch_id"
    for e in EMOTIONS
)

ORACLES: dict[str, str] = {
    # Sources, sinks and ingestion
    "scan_csv_comments": f"""WITH {COMMENTS} SELECT device, comment_id,
 nullif(comment, '') AS comment FROM comments""",
    "ingest_keyword_match": f"""WITH {COMMENTS} SELECT comment_id AS id, {strip('comment')} AS comment
 FROM comments WHERE lower(trim(device)) = 'en' AND comment <> ''""",
    "ingest_limit": f"""WITH {COMMENTS} SELECT comment_id AS id, {strip('comment')} AS comment
 FROM comments WHERE lower(trim(device)) = 'fr' AND comment <> '' ORDER BY comment_id LIMIT 50""",
    "ingest_ilike": f"""WITH {COMMENTS} SELECT comment_id AS id, {strip('comment')} AS comment
 FROM comments WHERE device ILIKE '%E_' AND comment IS NOT NULL""",
    "batch_slug_ingest": """SELECT doc_id, replace(lower(trim(' ' || source || ' A ' || lang)), ' ', '_')
 || '-' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS batch_id FROM documents""",
    "ingest_batch": f"""WITH {COMMENTS} SELECT comment_id AS id, 'de-0a1b2c3d' AS batch_id,
 'csv' AS platform, 'de' AS keyword, {strip('comment')} AS raw_text, {MOMENT} AS created_at,
 '{{}}' AS raw_json FROM comments WHERE lower(trim(device)) = 'de' AND comment <> ''""",
    "ingest_keys": f"""WITH {COMMENTS},
 kept AS (SELECT comment_id, {strip('comment')} AS raw_text, lower(trim(device)) AS lang
  FROM comments WHERE lower(trim(device)) IN ('en', 'de') AND comment <> '')
 SELECT row_number() OVER (ORDER BY lang DESC, comment_id, raw_text) AS id, lang || '-0a1b2c3d' AS batch_id,
 'csv' AS platform, CASE lang WHEN 'en' THEN 'en' ELSE 'De' END AS keyword, raw_text, {MOMENT} AS created_at
 FROM kept""",
    "raw_json_payload": """SELECT doc_id AS id, 'reddit' AS platform,
 CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END AS keyword,
 '{"upvotes":' || CASE WHEN doc_id % 3 = 0 THEN n_chars ELSE 100 END || ',"emotion":"'
 || CASE WHEN doc_id % 5 = 0 THEN 'joy' ELSE 'neutral' END || '","characteristic":"standard"}' AS raw_json
 FROM documents""",
    "cleaned_sink_roundtrip": f"""WITH {CLEANED} SELECT id, batch_id, cleaned_text, language,
 emoji_converted, status, CAST(processed_at AS VARCHAR) AS processed_at FROM cleaned_posts""",
    "enriched_sink_roundtrip": f"""WITH {ENRICHED} SELECT cleaned_post_id, batch_id, emotion_label,
 CAST(confidence AS DOUBLE) AS confidence,
 CASE WHEN emotion_label = 'joy' THEN CAST(confidence AS DOUBLE) ELSE 0e0 END AS joy,
 CAST(analyzed_at AS VARCHAR) AS analyzed_at FROM enriched_posts""",
    "export_csv_roundtrip": f"""WITH {ENRICHED} SELECT id, batch_id, emotion_label,
 CAST(confidence AS DOUBLE) AS confidence FROM enriched_posts""",
    "simple_clean_first_emoji": f"""WITH {RAW} SELECT id AS raw_post_id, batch_id,
 lower(regexp_replace(regexp_replace(raw_text, '[{SIMPLE_EMOJI}]', ''), '\\s+', ' ', 'g')) AS cleaned_text,
 'en' AS language, true AS emoji_converted FROM raw_posts""",
    "delete_batch_cascade": f"""WITH {RAW}, {CLEANED}, {ENRICHED},
 raw_posts_left AS (SELECT * FROM raw_posts WHERE batch_id <> 'src3'),
 cleaned_posts_left AS (SELECT * FROM cleaned_posts WHERE batch_id <> 'src3'
  AND raw_post_id NOT IN (SELECT id FROM raw_posts WHERE batch_id = 'src3')),
 enriched_posts_left AS (SELECT * FROM enriched_posts
  WHERE cleaned_post_id IN (SELECT id FROM cleaned_posts_left))
 {counted('raw_posts')} UNION ALL {counted('cleaned_posts')} UNION ALL {counted('enriched_posts')}
 UNION ALL SELECT 'raw_deleted', 'src3', count(*) FROM raw_posts WHERE batch_id = 'src3'
 UNION ALL SELECT 'cleaned_deleted', 'src3', count(*) FROM cleaned_posts WHERE batch_id = 'src3'""",
    # Batch assignment
    "search_posts": f"""WITH {RAW}, {FOUND.format('HA_PY', 1)} SELECT id, platform, keyword, raw_text,
 batch_id, CAST(created_at AS VARCHAR) AS created_at FROM found""",
    "search_topk": f"""WITH {RAW}, {FOUND.format('En', 50)} SELECT id, batch_id, keyword,
 CAST(created_at AS VARCHAR) AS created_at FROM newest""",
    "assign_batch": f"""WITH {RAW}, {FOUND.format('happy', 200)} SELECT id,
 CASE WHEN id IN (SELECT id FROM newest) THEN 'frontend-happy-1700000000' ELSE batch_id END AS batch_id,
 keyword FROM raw_posts""",
    "assign_preview": f"""WITH {RAW}, {FOUND.format('happy', 50)} SELECT id, batch_id, keyword, raw_text,
 (SELECT count(*) FROM newest) AS matched_count
 FROM newest ORDER BY created_at DESC NULLS FIRST, id DESC LIMIT 8""",
    "batch_slug_search": """SELECT doc_id, 'frontend-' || CASE WHEN doc_id % 9 = 0 THEN 'batch'
 ELSE source || '-' || lower(lang) END || '-' || CAST(doc_id + 1700000000 AS VARCHAR) AS batch_id
 FROM documents""",
    # Cleaning rules
    "clean_nfc": rule("nfc_normalize(text)"),
    "strip_urls": rule(gsub("text", URL)),
    "strip_mentions": rule(gsub("text", f"@{WORD}+")),
    "hashtags_noise": rule(noise_hashtags("text")),
    "hashtags_words": rule(hashtags("text")),
    "fix_entities": rule(entities("text")),
    "strip_separators": rule(separators("text")),
    "strip_ascii_art": rule(ascii_art("text")),
    "collapse_punct": rule(punct("text")),
    "collapse_whitespace": rule(whitespace("text")),
    "detection_text": rule(strip(gsub("text", f"_{WORD}+_"))),
    "clean_null_guard": f"""WITH {TEXTS} SELECT origin, id, CAST(NULL AS VARCHAR) AS cleaned_text,
 'en' AS language, false AS emoji_converted, 'too_short' AS status, '' AS flags
 FROM texts WHERE text IS NULL OR {strip('text')} = ''""",
    "emoji_known": f"""WITH {TEXTS}, named AS (SELECT *, {name_symbols('text')} AS out FROM texts)
 SELECT origin, id, out, coalesce(out <> nfc_normalize(text), false) AS hit FROM named""",
    "emoji_unknown": f"""WITH {TEXTS}, names AS (SELECT * FROM (VALUES
 {', '.join(f"('{s}', '_{n}_')" for s, n in unlisted_symbols().items())}) v(symbol, name)),
 uses AS (SELECT unnest(string_split(nfc_normalize(text), '')) AS symbol FROM texts)
 SELECT name AS symbol, count(*) AS uses FROM uses JOIN names USING (symbol) GROUP BY ALL""",
    "flag_all_caps": f"""WITH {TEXTS} SELECT origin, id, {letters('text')} AS letters,
 {capitals('text')} AS capitals, {all_caps('text')} AS all_caps FROM texts WHERE text IS NOT NULL
 UNION ALL SELECT origin, id, NULL, NULL, false FROM texts WHERE text IS NULL""",
    "script_latin": f"""WITH {TEXTS} SELECT origin, id, coalesce({latin('text')}, true) AS latin
 FROM texts""",
    "meaningful_words": f"""WITH {TEXTS} SELECT origin, id, {words('text')} AS words,
 {words('text')} >= 3 AS enough FROM texts""",
    "gibberish_score": f"""WITH {TEXTS}, s AS (SELECT origin, id, {strip('text')} AS t FROM texts)
 SELECT origin, id, len({tokens('t')}) AS tokens, {noise('t')} AS noise,
 coalesce({gibberish('t')}, false) AS gibberish FROM s""",
    "clean_batch": f"""WITH {RAW}, {cleaning('raw_posts', 'raw_text', 'id')}
 SELECT id AS post_id, batch_id, cleaned_text, language, emoji_converted, status, flags FROM cleaned""",
    "clean_rules": f"""WITH {TEXTS}, {cleaning('texts', 'text')}
 SELECT origin, id, cleaned_text, emoji_converted, status, flags FROM cleaned""",
    "clean_status": f"""WITH {TEXTS}, {cleaning('texts', 'text')} SELECT origin, id, status FROM cleaned""",
    "clean_flags": f"""WITH {TEXTS}, {cleaning('texts', 'text')}, each AS (
 SELECT origin, unnest(string_split(flags, ',')) AS flag FROM cleaned)
 SELECT origin, flag, count(*) AS posts FROM each WHERE flag <> '' GROUP BY ALL""",
    "clean_stage": f"""WITH {RAW}, {CLEANED}, todo AS (SELECT * FROM raw_posts r WHERE NOT EXISTS (
 SELECT 1 FROM cleaned_posts c WHERE c.raw_post_id = r.id)), {cleaning('todo', 'raw_text')}
 SELECT id, id AS raw_post_id, batch_id, coalesce(cleaned_text, '') AS cleaned_text, emoji_converted,
 status, flags, {MOMENT} AS processed_at FROM cleaned""",
    "clean_answer": f"""WITH {RAW}, {cleaning('raw_posts', 'raw_text')}
 SELECT id AS post_id, batch_id, cleaned_text, status FROM cleaned""",
    "status_breakdown": f"""WITH {RAW}, {cleaning('raw_posts', 'raw_text')}
 SELECT batch_id, status, count(*) AS posts FROM cleaned GROUP BY ALL""",
    # Language
    "langid_profile": f"WITH {PROFILE} SELECT lang, bucket, cost FROM profile",
    "langid_detect": f"""WITH {PROFILE}, {ranked('documents', 'doc_id', 'text')}
 SELECT doc_id, lang, cost FROM costs""",
    "langid_mixed": f"""WITH {TEXTS}, {PROFILE}, keyed AS (SELECT origin || id AS k, * FROM texts),
 {ranked('keyed', 'k', 'text')} SELECT origin, id, coalesce(language, 'en') AS language,
 coalesce(mixed_language, false) AS mixed_language FROM keyed LEFT JOIN detected USING (k)""",
    "langid_confusion": f"""WITH learned AS (SELECT * FROM documents WHERE doc_id % 5 <> 4),
 judged AS (SELECT * FROM documents WHERE doc_id % 5 = 4), {profile('learned')},
 {ranked('judged', 'doc_id', 'text')}
 SELECT lang, coalesce(language, 'en') AS language, count(*) AS posts
 FROM judged LEFT JOIN detected USING (doc_id) GROUP BY ALL""",
    "langid_joined": f"""WITH {PROFILE}, both_texts AS (SELECT a.doc_id, a.lang <> b.lang AS differ,
  a.text || ' ' || b.text AS text FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1),
 {ranked('both_texts', 'doc_id', 'text')}
 SELECT doc_id, differ, coalesce(language, 'en') AS language, coalesce(mixed_language, false) AS mixed_language
 FROM both_texts LEFT JOIN detected USING (doc_id)""",
    "langid_unknown": f"""WITH learned AS (SELECT * FROM documents WHERE doc_id % 5 <> 4 AND lang IN ('en', 'fr')),
 {profile('learned')}, {ranked('documents', 'doc_id', 'text')},
 each AS (SELECT pair_cost, count(*) AS n FROM detected JOIN documents USING (doc_id)
  WHERE doc_id % 5 = 4 AND lang IN ('en', 'fr') GROUP BY ALL),
 bound AS (SELECT min(pair_cost) AS most FROM (SELECT pair_cost, sum(n) OVER () AS every,
  sum(n) OVER (ORDER BY pair_cost) AS up_to FROM each) WHERE up_to >= 0.995e0 * every)
 SELECT doc_id, lang, CASE WHEN pair_cost > most THEN 'und' ELSE coalesce(language, 'en') END AS language
 FROM documents LEFT JOIN detected USING (doc_id) CROSS JOIN bound""",
    # Emotions
    "score_lexicon": f"""WITH {TEXTS}, {lexicon_score('texts', 'origin, id', 'text')}
 SELECT origin, id, emotion_label, confidence, {SEVEN} FROM labelled""",
    "emotion_profile": f"""WITH {TEXTS}, {emotion_costs()} SELECT label, prior, bucket, cost FROM model""",
    "emotion_agreement": f"""WITH {TEXTS}, {emotion_costs()},
 judged AS (SELECT origin, id, h.label, m.label AS told, sum(cost) + any_value(prior) AS cost
  FROM hashed h JOIN model m USING (bucket) WHERE id % 5 = 4 GROUP BY ALL),
 wordless AS (SELECT origin, id, label, told, prior AS cost FROM weak CROSS JOIN
  (SELECT DISTINCT label AS told, prior FROM model)
  WHERE id % 5 = 4 AND (origin, id) NOT IN (SELECT (origin, id) FROM hashed)),
 placed AS (SELECT *, row_number() OVER (PARTITION BY origin, id
  ORDER BY cost, list_position([{listed(EMOTIONS)}], told)) AS place
  FROM (SELECT * FROM judged UNION ALL SELECT * FROM wordless))
 SELECT label, told, count(*) AS texts FROM placed WHERE place = 1 GROUP BY ALL""",
    "score_fallback": f"""WITH {RAW}, flaky AS (SELECT id,
 coalesce(regexp_matches(raw_text, '{SOLID}'), false) AS filled, coalesce(length(raw_text) % 2, 0) = 0 AS fine
 FROM raw_posts), each AS (SELECT id, filled AND NOT fine AS scoring_failed, filled AND fine AS ok FROM flaky)
 SELECT id, scoring_failed, CASE WHEN ok THEN 'fear' ELSE 'neutral' END AS emotion_label,
 CASE WHEN ok THEN 0.75e0 ELSE 1e0 END AS confidence, 0e0 AS joy, 0e0 AS anger,
 CASE WHEN ok THEN 0.75e0 ELSE 0e0 END AS fear, 0e0 AS disgust, 0e0 AS sadness, 0e0 AS surprise,
 CASE WHEN ok THEN 0e0 ELSE 1e0 END AS neutral FROM each""",
    "score_normalize": f"WITH {MADE_UP} SELECT doc_id, {SEVEN} FROM labelled",
    "score_argmax": f"WITH {MADE_UP} SELECT doc_id, emotion_label, confidence FROM labelled",
    "confidence_decimal": f"""WITH {MADE_UP} SELECT doc_id,
 CAST(CAST(CAST(confidence AS VARCHAR) AS DECIMAL(3,2)) AS DOUBLE) AS confidence FROM labelled""",
    "enrich_record": f"""WITH {MADE_UP}, stored AS (SELECT *,
 CAST(CAST(CAST(confidence AS VARCHAR) AS DECIMAL(3,2)) AS DOUBLE) AS c FROM labelled)
 SELECT doc_id AS cleaned_post_id, source AS batch_id, emotion_label, c AS confidence,
 c AS emotion_intensity, joy, sadness, {MOMENT} AS analyzed_at FROM stored""",
    "enrich_stage": f"""WITH {CLEANED}, {ENRICHED}, {UNANALYZED},
 todo AS (SELECT * FROM unanalyzed WHERE language = 'en'),
 {lexicon_score('todo', 'id, batch_id', 'cleaned_text')}
 SELECT id AS cleaned_post_id, batch_id, emotion_label,
 CAST(CAST(CAST(confidence AS VARCHAR) AS DECIMAL(3,2)) AS DOUBLE) AS confidence FROM labelled""",
    # Joins
    "unanalyzed_posts": f"""WITH {CLEANED}, {ENRICHED}, {UNANALYZED}
 SELECT id, batch_id, language, cleaned_text FROM unanalyzed WHERE language = 'en'""",
    "uncleaned_posts": f"""WITH {RAW}, {CLEANED} SELECT id, batch_id, keyword FROM raw_posts r
 WHERE NOT EXISTS (SELECT 1 FROM cleaned_posts c WHERE c.raw_post_id = r.id)""",
    "joined_posts": f"""WITH {JOINED} SELECT raw_post_id, batch_id, raw_text, keyword, cleaned_text,
 language, emotion_label, CAST(confidence AS DOUBLE) AS confidence,
 CAST(analyzed_at AS VARCHAR) AS analyzed_at FROM joined""",
    "unanalyzed_by_batch": f"""WITH {CLEANED}, {ENRICHED}, {UNANALYZED}
 SELECT batch_id, count(*) AS unanalyzed FROM unanalyzed GROUP BY ALL""",
    # Counts and reports
    "cleaning_stats": f"""WITH {RAW}, {CLEANED},
 r AS (SELECT batch_id, count(*) AS total_raw FROM raw_posts GROUP BY ALL),
 c AS (SELECT batch_id, count(*) AS cleaned FROM cleaned_posts GROUP BY ALL)
 SELECT batch_id, coalesce(total_raw, 0) AS total_raw, coalesce(cleaned, 0) AS cleaned,
 coalesce(total_raw, 0) - coalesce(cleaned, 0) AS pending,
 round(coalesce(cleaned, 0) / total_raw * 100, 1) AS completion_pct FROM r FULL JOIN c USING (batch_id)""",
    "analysis_stats": f"""WITH {CLEANED}, {ENRICHED},
 c AS (SELECT batch_id, count(*) AS total_posts FROM cleaned_posts GROUP BY ALL),
 e AS (SELECT batch_id, count(*) AS analyzed FROM enriched_posts GROUP BY ALL)
 SELECT batch_id, coalesce(total_posts, 0) AS total_posts, coalesce(analyzed, 0) AS analyzed,
 coalesce(total_posts, 0) - coalesce(analyzed, 0) AS pending FROM c FULL JOIN e USING (batch_id)""",
    "batch_results": f"""WITH {ENRICHED} SELECT batch_id, (SELECT count(*) FROM enriched_posts) AS total_results,
 id, emotion_label, CAST(confidence AS DOUBLE) AS confidence, CAST(analyzed_at AS VARCHAR) AS analyzed_at
 FROM enriched_posts""",
    "hero_counts": f"""WITH {JOINED} SELECT batch_id, count(*) AS total, count(emotion_label) AS analyzed,
 count(*) - count(emotion_label) AS pending FROM joined GROUP BY ALL""",
    "emotion_distribution": f"WITH {JOINED} {BY_EMOTION}",
    "emotion_share": f"WITH {JOINED} {BY_SHARE}",
    "emotion_percentage": f"""WITH {ENRICHED} SELECT batch_id, emotion_label, count(*) AS posts,
 round(count(*) / (SELECT count(*) FROM enriched_posts x WHERE x.batch_id = e.batch_id) * 100, 2) AS percentage
 FROM enriched_posts e GROUP BY batch_id, emotion_label""",
    "confidence_by_emotion": f"""WITH {ENRICHED} SELECT emotion_label, count(*) AS posts,
 round(CAST(sum(confidence) AS DOUBLE) / count(confidence), 4) AS avg_confidence,
 CAST(min(confidence) AS DOUBLE) AS min_confidence, CAST(max(confidence) AS DOUBLE) AS max_confidence
 FROM enriched_posts GROUP BY ALL""",
    "emotion_by_batch": f"""WITH {ENRICHED} SELECT batch_id, emotion_label, count(*) AS posts,
 round(CAST(sum(confidence) AS DOUBLE) / count(confidence), 4) AS avg_confidence
 FROM enriched_posts GROUP BY ALL""",
    "posts_per_batch_cleaned": f"""WITH {CLEANED} SELECT batch_id, count(*) AS posts
 FROM cleaned_posts GROUP BY ALL""",
    "posts_per_batch_raw": f"WITH {RAW} SELECT batch_id, count(*) AS posts FROM raw_posts GROUP BY ALL",
    "distinct_counts": f"""WITH {RAW} SELECT count(DISTINCT batch_id) AS batches,
 count(DISTINCT platform) AS platforms, count(DISTINCT keyword) AS keywords FROM raw_posts""",
    "fleet_status": f"""WITH {CLEANED}, {ENRICHED}, {UNANALYZED} SELECT
 (SELECT count(*) FROM enriched_posts) AS total_enriched,
 (SELECT count(*) FROM unanalyzed WHERE language = 'en') AS pending""",
    "unanalyzed_limit": f"""WITH {CLEANED}, {ENRICHED}, {UNANALYZED},
 todo AS (SELECT * FROM unanalyzed WHERE language = 'en' ORDER BY id LIMIT 100),
 {lexicon_score('todo', 'id, batch_id', 'cleaned_text')}
 SELECT id AS cleaned_post_id, batch_id, emotion_label FROM labelled""",
    "table_counts": f"""WITH {RAW}, {CLEANED}, {ENRICHED}
 SELECT 'raw_posts' AS table_name, count(*) AS rows FROM raw_posts
 UNION ALL SELECT 'cleaned_posts', count(*) FROM cleaned_posts
 UNION ALL SELECT 'enriched_posts', count(*) FROM enriched_posts""",
    "batch_count_report": f"""WITH {RAW} SELECT 'Total Raw Posts' AS metric, count(*) AS posts FROM raw_posts
 UNION ALL SELECT 'Test Batch: Zero', count(*) FROM raw_posts WHERE batch_id = 'src0'
 UNION ALL SELECT 'Test Batch: Seven', count(*) FROM raw_posts WHERE batch_id = 'src7'
 UNION ALL SELECT 'Test Batch: Absent', count(*) FROM raw_posts WHERE batch_id = 'absent'""",
    # Explorer
    "explore_text": f"""WITH {JOINED} SELECT raw_post_id, emotion_label,
 coalesce(CAST(confidence AS DOUBLE), 0) AS confidence FROM joined
 WHERE regexp_matches(lower(coalesce(raw_text, '')), 'happy|an(gr)y')
 OR regexp_matches(lower(coalesce(cleaned_text, '')), 'happy|an(gr)y')""",
    "explore_literal": f"""WITH {JOINED} SELECT raw_post_id, emotion_label,
 coalesce(CAST(confidence AS DOUBLE), 0) AS confidence FROM joined
 WHERE contains(lower(coalesce(raw_text, '')), 'wow!!!! why???')
 OR contains(lower(coalesce(cleaned_text, '')), 'wow!!!! why???')""",
    "explore_emotion": f"""WITH {JOINED} SELECT raw_post_id, emotion_label,
 CAST(confidence AS DOUBLE) AS confidence FROM joined WHERE emotion_label = 'fear'""",
    "explore_confidence": f"""WITH {JOINED}, w AS (SELECT raw_post_id, CASE WHEN raw_post_id % 4 = 0 THEN 0e0
 ELSE coalesce(CAST(confidence AS DOUBLE), 0e0) END AS confidence FROM joined)
 SELECT raw_post_id, confidence FROM w WHERE confidence >= 0.25e0""",
    "shorten_text": f"""WITH {TEXTS} SELECT origin, id, {shorten('text', 180)} AS short,
 {shorten('text', 160)} AS shorter FROM texts""",
    "explore_view": f"""WITH {JOINED} SELECT raw_post_id, {shorten('raw_text', 180)} AS raw_text,
 {shorten('cleaned_text', 160)} AS cleaned_text, coalesce(emotion_label, 'pending') AS emotion,
 round(CAST(confidence AS DOUBLE) * 100, 1) AS confidence_pct, keyword FROM joined
 WHERE CAST(confidence AS DOUBLE) >= 0.1e0 AND (regexp_matches(lower(coalesce(raw_text, '')), 'the|der')
 OR regexp_matches(lower(coalesce(cleaned_text, '')), 'the|der'))""",
    "explore_counts": f"""WITH {JOINED} SELECT count(*) AS total,
 count(*) FILTER (emotion_label = 'joy' AND confidence >= 0.5) AS shown FROM joined""",
    "sample_posts": f"""WITH {RAW} SELECT id, batch_id, substring(raw_text, 1, 70) AS raw_text
 FROM raw_posts ORDER BY id LIMIT 20""",
    "raw_posts_by_batch": f"WITH {RAW} SELECT id, batch_id, keyword, raw_text FROM raw_posts",
    "json_upvotes": "SELECT doc_id AS id, n_chars AS upvotes FROM documents",
    "json_event_props": """WITH e AS (SELECT event_type,
 TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
 SELECT event_type, count(k) AS with_k, CAST(sum(k) AS BIGINT) AS sum_k, max(k) AS max_k
 FROM e GROUP BY ALL""",
}

# A stream ends where a batch run ends: all posts cleaned, those taken for English scored.
ORACLES["stream_clean"] = f"""WITH {RAW}, {cleaning('raw_posts', 'raw_text')},
 todo AS (SELECT id, batch_id, coalesce(cleaned_text, '') AS cleaned_text FROM cleaned),
 {lexicon_score('todo', 'id, batch_id, cleaned_text', 'cleaned_text')}
 SELECT id AS raw_post_id, batch_id, cleaned_text, emotion_label,
 CAST(CAST(CAST(confidence AS VARCHAR) AS DECIMAL(3,2)) AS DOUBLE) AS confidence FROM labelled"""

VOWELS = ", ".join(
    f"length(lower(text)) - length(replace(lower(text), '{v}', '')) AS {v}" for v in "aeiou"
)
ORACLES["score_model_stub"] = f"""WITH vowels AS (SELECT conv_id, turn, {VOWELS} FROM conversations),
 sums AS (SELECT *, greatest(1, a + e + i + o + u) AS total FROM vowels),
 scored AS (SELECT conv_id, turn, round(a / total, 4) AS joy, round(e / total, 4) AS anger,
  round(i / total, 4) AS fear, 0e0 AS disgust, round(o / total, 4) AS sadness, 0e0 AS surprise,
  round(u / total, 4) AS neutral FROM sums),
 {labelled('scored')} SELECT conv_id, turn, emotion_label, confidence, {SEVEN} FROM labelled"""

ORACLES["delete_stored_batch"] = ORACLES["delete_batch_cascade"]
ORACLES["joined_in_place"] = ORACLES["joined_posts"]
ORACLES["unanalyzed_in_place"] = ORACLES["unanalyzed_posts"]

"""The registered queries in DuckDB's SQL, written from their meaning and not from the Spark plans."""

from __future__ import annotations

from feedlens.functions.actions import DEFAULT_ACTION, DEFAULT_BUCKET, DEFAULT_RULES
from feedlens.schema import BUCKETS, PLACES, POST_URL, SENTIMENTS, THEMES, TOPICS

SPLIT = "TIMESTAMP '2024-01-08'"
AS_OF = "TIMESTAMP '2024-02-01'"
ORACLE: dict[str, str] = {}


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def texts(values) -> str:
    return ", ".join(text(v) for v in values)


def choose(number: str, values) -> str:
    return f"(CAST([{texts(values)}] AS VARCHAR[]))[CAST(({number}) % {len(values)} AS INTEGER) + 1]"


LOCATIONS = ("World Trade Center", "Port Vell", "Montjuïc", "unknown", " ", None, " Gràcia ",
             "WTC Barcelona", "Madrid")

FEED = f"""
base AS (
  SELECT d.doc_id * 5 AS event_id, 'doc:' || d.doc_id AS item_id, 'post' AS item_type,
         CAST(NULL AS VARCHAR) AS parent_id, d.source AS author_headline, d.text, d.lang,
         CAST(d.n_chars % 7 AS INTEGER) AS reposts, 'https://feed.example/' || d.doc_id AS url,
         'file' AS source
  FROM documents d
  UNION ALL
  SELECT v.conv_id * 8 + v.turn, 'conv:' || v.conv_id || ':' || v.turn,
         CASE WHEN v.turn = 0 THEN 'post' ELSE 'comment' END,
         CASE WHEN v.turn <> 0 THEN 'conv:' || v.conv_id || ':0' END, v.role, v.text, NULL,
         0, NULL, 'linkedin_api'
  FROM conversations v),
feed AS (
  SELECT b.item_id, b.item_type, b.parent_id, CAST(e.user_id AS VARCHAR) AS author,
         b.author_headline, b.text, b.lang, e.ts AS created_at,
         CAST(floor(e.value) AS INTEGER) AS reactions,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS comments, b.reposts, b.url,
         b.source,
         CASE e.event_type WHEN 'purchase' THEN 'positive' WHEN 'error' THEN 'negative'
                           WHEN 'click' THEN 'mixed' ELSE 'neutral' END AS sentiment,
         {choose("e.event_id", TOPICS)} AS topic, {choose("e.user_id", THEMES)} AS theme,
         CASE WHEN e.user_id % 11 <> 0 THEN {choose("e.user_id + e.event_id", BUCKETS)} END
           AS action_bucket,
         {choose("e.user_id", LOCATIONS)} AS location,
         CASE WHEN e.user_id % 3 <> 0 THEN 'Speaker ' || (e.user_id % 17) END AS speaker,
         CASE WHEN e.user_id % 3 <> 0 THEN 'Company ' || (e.user_id % 17) END AS company
  FROM base b LEFT JOIN events e ON e.event_id = b.event_id)"""

GOLD = FEED + """,
gold AS (
  SELECT item_id, item_type, parent_id, created_at, sentiment, topic, theme, speaker, company,
         location,
         CAST(reactions AS BIGINT) + comments + reposts AS engagement, author_headline,
         CASE WHEN lang = 'en' THEN text END AS text_en, text AS original_text, action_bucket,
         'Do: ' || action_bucket AS recommended_action, url, source
  FROM feed)"""

BRONZE_COLS = ("item_id, item_type, parent_id, author, author_headline, text, lang, created_at, "
               "reactions, comments, reposts, url, source")


def on_feed(name: str, body: str, *parts: str) -> None:
    ORACLE[name] = "WITH " + ",".join((FEED, *parts)) + "\n" + body


def on_gold(name: str, body: str) -> None:
    ORACLE[name] = "WITH " + GOLD + "\n" + body


# ---- read queries -------------------------------------------------------------------------------

def counted(keys: str, where: str = "TRUE") -> str:
    return f"SELECT {keys}, count(*) AS items FROM gold WHERE {where} GROUP BY {keys}"


def running(hour: str) -> str:
    return f"""
SELECT hour, sentiment,
       CAST(sum(c) OVER (PARTITION BY sentiment ORDER BY hour) AS BIGINT) AS cumulative_items
FROM (SELECT {hour} AS hour, sentiment, count(*) AS c FROM gold GROUP BY 1, 2)"""


UTC_HOUR = "date_trunc('hour', created_at)"
LOCAL_TIME = "timezone('Europe/Madrid', timezone('UTC', created_at))"
LOCAL_HOUR = f"date_trunc('hour', {LOCAL_TIME})"

on_gold("total_items", "SELECT count(*) AS total_items FROM gold")
on_gold("sentiment_mix", counted("sentiment"))
on_gold("theme_by_sentiment", counted("theme, sentiment"))
on_gold("theme_by_sentiment_named", counted("theme, sentiment", "theme IS NOT NULL"))
on_gold("theme_counts", counted("theme", "theme IS NOT NULL"))
on_gold("bucket_counts", counted("action_bucket", "action_bucket IS NOT NULL"))
on_gold("bucket_counts_all", counted("action_bucket"))
on_gold("source_flag_count",
        "SELECT count(*) FILTER (WHERE source = 'linkedin_api') AS items FROM gold")
on_gold("hourly_sentiment_utc",
        f"SELECT {UTC_HOUR} AS hour, sentiment, count(*) AS items FROM gold GROUP BY 1, 2")
on_gold("hourly_sentiment_local",
        f"SELECT {LOCAL_HOUR} AS hour, sentiment, count(*) AS items FROM gold GROUP BY 1, 2")
on_gold("hourly_running_utc", running(UTC_HOUR))

# The flagship query starts from raw rows, in which low reaction counts are missing; the count of
# items does not depend on that.
on_gold("hourly_running_local", running(LOCAL_HOUR))


def resonance(key: str, where: str = "TRUE") -> str:
    # The share as a decimal: rounded to five digits first, then to two.
    return f"""
SELECT {key}, mentions, engagement,
       CAST((((200000 * pos + mentions) // (2 * mentions) + 500) // 1000) / 100.0
            AS DECIMAL(13, 2)) AS positive_share
FROM (SELECT {key}, count(*) AS mentions, CAST(sum(engagement) AS BIGINT) AS engagement,
             count(*) FILTER (WHERE sentiment = 'positive') AS pos
      FROM gold WHERE {where} GROUP BY {key})"""


on_gold("resonance_by_theme", resonance("theme"))
on_gold("resonance_by_speaker", resonance("speaker", "speaker IS NOT NULL"))
on_gold("top_theme", """
SELECT theme, count(*) FILTER (WHERE sentiment = 'positive') AS positive_items, count(*) AS items
FROM gold WHERE theme IS NOT NULL AND theme <> 'other'
GROUP BY theme ORDER BY positive_items DESC, items DESC, theme LIMIT 1""")
on_gold("mood_share", """
SELECT count(*) AS total,
       CAST(round(100.0 * count(*) FILTER (WHERE sentiment = 'positive') / count(*)) AS BIGINT)
         AS positive_pct,
       CAST(round(100.0 * count(*) FILTER (WHERE sentiment = 'negative') / count(*)) AS BIGINT)
         AS negative_pct
FROM gold""")
on_gold("sentiment_by_day", f"""
SELECT day, items,
       {", ".join(f"{s}_share" for s in SENTIMENTS)},
       {", ".join(f"round({s}_share - lag({s}_share) OVER (ORDER BY day), 6) AS {s}_change"
                  for s in SENTIMENTS)}
FROM (SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(created_at AS DATE)) + 1 AS INTEGER)
               AS day, count(*) AS items,
             {", ".join(f"round(CAST(count(*) FILTER (WHERE sentiment = '{s}') AS DOUBLE)"
                        f" / count(*), 6) AS {s}_share" for s in SENTIMENTS)}
      FROM gold GROUP BY 1)""")
on_gold("daily_summary", """
SELECT CAST(created_at AS DATE) AS day, count(*) AS items,
       CAST(sum(engagement) AS BIGINT) AS engagement,
       round(avg(engagement), 4) AS avg_engagement, max(engagement) AS max_engagement
FROM gold GROUP BY 1""")
on_gold("top_entities", """
SELECT kind, CAST(rank AS INTEGER) AS rank, name, items
FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY items DESC, name) AS rank
      FROM (SELECT kind, name, count(*) AS items
            FROM (SELECT 'speaker' AS kind, speaker AS name FROM gold
                  UNION ALL SELECT 'company', company FROM gold
                  UNION ALL SELECT 'location', location FROM gold)
            WHERE name IS NOT NULL GROUP BY kind, name))
WHERE rank <= 10""")
on_gold("thread_rollup", """
SELECT p.item_id AS post_id, count(c.item_id) AS replies,
       any_value(p.engagement) AS post_engagement,
       CAST(coalesce(sum(c.engagement), 0) AS BIGINT) AS reply_engagement
FROM gold p LEFT JOIN gold c ON c.parent_id = p.item_id AND c.item_type = 'comment'
WHERE p.item_type = 'post' GROUP BY p.item_id""")
on_gold("recent_items", """
SELECT created_at, item_type, sentiment, topic, theme, speaker, company, engagement, action_bucket,
       recommended_action, text_en, original_text, url
FROM gold ORDER BY created_at DESC, item_id LIMIT 50""")


def cut(column: str) -> str:
    return (f"CASE WHEN length({column}) > 400 THEN array_slice({column}, 1, 400) || '…' "
            f"ELSE coalesce({column}, '') END AS {column}")


on_gold("wall", f"""
SELECT strftime({LOCAL_TIME}, '%d %b %H:%M') AS time, item_type, sentiment, topic, theme, speaker,
       company, engagement, action_bucket, recommended_action, {cut("text_en")},
       {cut("original_text")}, CASE WHEN starts_with(url, 'https://') THEN url END AS link
FROM (SELECT * FROM gold ORDER BY created_at DESC, item_id LIMIT 200)""")
on_gold("top_problems", """
SELECT topic, recommended_action, text_en, engagement FROM gold
WHERE sentiment = 'negative' OR topic IN ('session complaint', 'logistics')
ORDER BY engagement DESC, item_id LIMIT 20""")
on_gold("open_leads", """
SELECT created_at, company, recommended_action, text_en, url FROM gold
WHERE action_bucket = 'follow_up' OR topic = 'sponsor & lead signal'""")
USABLE = "location IS NOT NULL AND trim(location) <> '' AND lower(location) <> 'unknown'"
on_gold("location_moods", f"""
SELECT lower(trim(location)) AS location, sentiment, count(*) AS items FROM gold
WHERE {USABLE} GROUP BY 1, 2""")
on_gold("top_locations", f"""
SELECT location, count(*) AS items FROM gold WHERE {USABLE}
GROUP BY location ORDER BY items DESC, location LIMIT 12""")
PLACE_ROWS = ", ".join(f"({i}, {text(n)}, CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))"
                       for i, (n, lat, lon) in enumerate(PLACES))
on_gold("place_mood", f""",
places(priority, name, lat, lon) AS (VALUES {PLACE_ROWS}),
named AS (SELECT lower(trim(location)) AS location, sentiment FROM gold WHERE {USABLE}),
hits AS (
  SELECT n.location, arg_min(p.lat, p.priority) AS lat, arg_min(p.lon, p.priority) AS lon
  FROM (SELECT DISTINCT location FROM named) n
  JOIN places p ON contains(strip_accents(n.location), p.name) GROUP BY n.location),
spots AS (
  SELECT lat, lon, count(*) AS items, min(location) AS location,
         {", ".join(f"count(*) FILTER (WHERE sentiment = '{s}') AS {s}" for s in SENTIMENTS)}
  FROM named JOIN hits USING (location) GROUP BY lat, lon)
SELECT lat, lon,
       array_to_string(list_transform(string_split(location, ' '),
                                      lambda w: upper(w[1]) || w[2:]), ' ') AS place,
       items, {", ".join(SENTIMENTS)},
       CASE greatest({", ".join(SENTIMENTS)})
         {" ".join(f"WHEN {s} THEN '{s}'" for s in SENTIMENTS)} END AS mood,
       120 + 55 * items AS radius
FROM spots""".lstrip("\n"))
on_gold("event_day_two", counted("sentiment", "CAST(created_at AS DATE) = DATE '2024-01-02'"))
on_gold("last_hour", """
SELECT item_id, created_at FROM gold
WHERE created_at > (SELECT max(created_at) FROM gold) - INTERVAL 1 HOUR""")

# ---- sources and normalising --------------------------------------------------------------------

RAW = """
raw AS (
  SELECT * REPLACE (CASE WHEN reactions > 5 THEN reactions END AS reactions) FROM feed)"""
PSEUDONYM = "substr(sha256(author), 1, 16)"
NORMALIZED = f"""
SELECT item_id, item_type, parent_id, {PSEUDONYM} AS author, author_headline, text, lang,
       created_at, coalesce(reactions, 0) AS reactions, comments, reposts, url, source
FROM raw WHERE regexp_matches(text, '\\S')"""
on_feed("feed_normalized", NORMALIZED, RAW)
on_feed("stream_upsert", f"SELECT *, {AS_OF} AS ingestion_time FROM ({NORMALIZED})", RAW)
on_feed("surrogate_keys", """
SELECT item_id, sha256(concat_ws('|', CASE WHEN parent_id IS NULL THEN author END, text)) AS key
FROM feed""")
on_feed("keyword_filter", """
SELECT item_id, source FROM feed
WHERE source <> 'file' OR item_type = 'comment'
   OR contains(lower(text), 'mit license') OR contains(lower(text), 'worthless')
   OR contains(lower(text), 'disgusting') OR contains(lower(text), 'c++ (notes)')""")
on_feed("markup_clean", r"""
SELECT item_id, regexp_replace(regexp_replace('#1 #Feed ' || text || ' by @Ann Lee (ok)',
    '\\([\\()\[\]{}@#*_~<>|])', '\1', 'g'), '\s+$', '') AS text
FROM feed""")
on_feed("read_files", """
SELECT item_id, CASE WHEN source <> 'file' THEN item_type END AS item_type, parent_id, author,
       text, strftime(created_at, '%Y-%m-%d %H:%M:%S')
         || regexp_replace(strftime(created_at, '.%f'), '\\.?0+$', '') AS created_at,
       reactions, comments, reposts
FROM raw""", RAW)
on_feed("rejected_count", """
SELECT count(*) FILTER (WHERE author_headline = 'system' OR text IS NULL
                        OR NOT regexp_matches(text, '\\S')) AS rejected, count(*) AS rows
FROM feed""")

on_feed("reject_counts", """
SELECT 'corrupt_line' AS cause, count(*) FILTER (WHERE length(text) % 11 = 3) AS rows FROM feed
UNION ALL SELECT 'wrong_type', count(*) FILTER (WHERE length(text) % 11 = 5) FROM feed
UNION ALL SELECT 'no_text', count(*) FILTER (WHERE length(text) % 11 <> 3 AND (
    author_headline = 'system' OR NOT regexp_matches(text, '\\S'))) FROM feed
UNION ALL SELECT 'no_key', count(*) FILTER (WHERE length(text) % 11 = 7
    AND author_headline <> 'system' AND regexp_matches(text, '\\S')) FROM feed""")
on_feed("reply_buckets", """
SELECT 'escalate' AS bucket, count(*) AS replies FROM feed WHERE length(text) % 3 = 0""")

MILLIS = "make_timestamp_ms(epoch_us(created_at) // 1000)"
CLEAN = (r"regexp_replace(regexp_replace(text, '\\([\\()\[\]{}@#*_~<>|])', '\1', 'g'), "
         r"'^\s+|\s+$', '', 'g')")
PAYLOADS = f"""
landed_posts AS (
  SELECT item_id, author, CASE WHEN author_headline <> 'user' THEN {CLEAN} END AS text,
         {MILLIS} AS created_at, reactions, comments, reposts, source
  FROM feed WHERE item_type = 'post' AND {MILLIS} >= {SPLIT}),
landed_comments AS (
  SELECT CASE WHEN author_headline = 'user' THEN item_id ELSE parent_id || '#comment:' || item_id
         END AS item_id, parent_id, 'urn:li:organization:' || author AS author, {CLEAN} AS text,
         {MILLIS} AS created_at, reactions, comments
  FROM feed WHERE item_type = 'comment' AND regexp_matches(text, '\\S'))"""
on_feed("payload_posts", "SELECT item_id, author, text, created_at FROM landed_posts", PAYLOADS)
on_feed("payload_comments", "SELECT * FROM landed_comments", PAYLOADS)
on_feed("payload_reactions", """
SELECT item_id AS post_id, reactions + reposts AS reactions, comments FROM feed
WHERE item_type = 'post' AND source = 'file'""")
on_feed("payload_items", f"""
SELECT item_id, 'post' AS item_type, CAST(NULL AS VARCHAR) AS parent_id, {PSEUDONYM} AS author,
       CAST(NULL AS VARCHAR) AS author_headline, text, CAST(NULL AS VARCHAR) AS lang, created_at,
       CASE WHEN source = 'file' THEN reactions + reposts ELSE 0 END AS reactions,
       CASE WHEN source = 'file' THEN comments ELSE 0 END AS comments, 0 AS reposts,
       '{POST_URL[0]}' || item_id || '{POST_URL[1]}' AS url, 'linkedin_api' AS source
FROM landed_posts WHERE regexp_matches(text, '\\S')
UNION ALL
SELECT item_id, 'comment', parent_id, author, NULL, text, NULL, created_at, reactions, comments, 0,
       '{POST_URL[0]}' || parent_id || '{POST_URL[1]}', 'linkedin_api'
FROM landed_comments WHERE parent_id IN (SELECT item_id FROM landed_posts)""", PAYLOADS)

# ---- upsert and layers --------------------------------------------------------------------------

on_feed("dedup_rows", f"""
SELECT {BRONZE_COLS.replace("reactions", "reactions + greatest(reposts - 3, 0) AS reactions")}
FROM feed""")
MERGED = f"""
SELECT {BRONZE_COLS.replace(" text,", f" CASE WHEN created_at < {SPLIT} THEN '' ELSE 'edited: ' END || text AS text,")
        .replace("reactions", "reactions + 3 AS reactions")},
       CASE WHEN created_at < {SPLIT} THEN {SPLIT} ELSE {AS_OF} END AS ingestion_time
FROM feed"""
on_feed("upsert_merge", MERGED)
on_feed("store_upsert", MERGED)
on_feed("new_items", f"SELECT count(*) AS new_items FROM feed WHERE created_at >= {SPLIT}")
on_feed("silver_pending", f"SELECT item_id, text FROM feed WHERE created_at >= {SPLIT}")
on_gold("gold_table", f"""
SELECT * REPLACE (CASE WHEN created_at < {SPLIT} THEN engagement ELSE 0 END AS engagement)
FROM gold""")
on_feed("bronze_preview", f"""
SELECT {BRONZE_COLS}, {AS_OF} AS ingestion_time FROM feed
ORDER BY created_at DESC, item_id LIMIT 50""")
on_gold("silver_preview", """
SELECT g.item_id, g.item_type, g.parent_id, g.created_at, g.author_headline, f.lang, g.source,
       g.url, original_text, g.sentiment, g.topic, g.theme, text_en, g.action_bucket,
       recommended_action, g.speaker, g.company, g.location
FROM gold g JOIN feed f USING (item_id) ORDER BY g.created_at DESC, g.item_id LIMIT 50""")
on_gold("gold_preview", "SELECT * FROM gold ORDER BY created_at DESC, item_id LIMIT 50")
on_feed("json_preview", """
SELECT item_id, CASE WHEN source <> 'file' THEN item_type END AS item_type, lang, text FROM feed
ORDER BY item_id, text LIMIT 10""")

# ---- enrichment ---------------------------------------------------------------------------------


def words(column: str) -> str:
    return f"regexp_extract_all(lower(coalesce({column}, '')), '[\\p{{L}}\\p{{M}}\\p{{N}}]+')"


TOKENS = f"tokens AS (SELECT item_id, unnest({words('text')}) AS term FROM feed)"
LEXICON = f"""
lex_counts AS (
  SELECT term, count(*) FILTER (WHERE rating = 'positive') AS pos,
         count(*) FILTER (WHERE rating = 'negative') AS neg
  FROM (SELECT CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'positive' ELSE 'negative' END
                 AS rating, unnest({words('d.text')}) AS term
        FROM documents d JOIN labels l USING (doc_id))
  GROUP BY term),
lexicon AS (
  SELECT term, weight
  FROM (SELECT term, CAST(round(1000 * (
                 ln((pos + 1) / (SELECT CAST(sum(pos) + count(*) AS BIGINT) FROM lex_counts))
                 - ln((neg + 1) / (SELECT CAST(sum(neg) + count(*) AS BIGINT) FROM lex_counts))
               )) AS BIGINT) AS weight
        FROM lex_counts))"""
TONE = """
tone AS (
  SELECT f.item_id, CAST(coalesce(sum(greatest(weight, 0)), 0) AS BIGINT) AS pos_score,
         CAST(coalesce(sum(greatest(-weight, 0)), 0) AS BIGINT) AS neg_score
  FROM feed f LEFT JOIN tokens t USING (item_id) LEFT JOIN lexicon USING (term)
  GROUP BY f.item_id),
toned AS (
  SELECT *, CASE WHEN pos_score = 0 AND neg_score = 0 THEN 'neutral'
                 WHEN 100 * least(pos_score, neg_score) >= 80 * greatest(pos_score, neg_score)
                   THEN 'mixed'
                 WHEN pos_score > neg_score THEN 'positive' ELSE 'negative' END AS sentiment
  FROM tone)"""
ORACLE["lexicon_learn"] = f"WITH {LEXICON} SELECT * FROM lexicon"
on_feed("sentiment_score", "SELECT * FROM toned", TOKENS, LEXICON, TONE)


def listed(name: str, labels, default: str) -> str:
    """The label whose terms occur most often in an item."""
    return f"""
{name}_terms AS (
  SELECT DISTINCT CAST(item_id % {len(labels)} AS INTEGER) AS slot, term
  FROM (SELECT item_id, unnest({words('text')}) AS term FROM benchmark)),
{name}_hits AS (
  SELECT item_id, slot, count(*) AS n FROM tokens JOIN {name}_terms USING (term) GROUP BY 1, 2),
{name}_best AS (
  SELECT f.item_id, coalesce(([{texts(labels)}])[h.slot + 1], '{default}') AS {name}
  FROM feed f LEFT JOIN (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, slot) AS r
    FROM {name}_hits) h ON h.item_id = f.item_id AND h.r = 1)"""


LANGUAGES = ("de", "en", "es", "fr")
BAYES = f"""
lang_counts AS (
  SELECT term, {", ".join(f"count(*) FILTER (WHERE lang = '{lang}') AS {lang}"
                          for lang in LANGUAGES)}
  FROM (SELECT lang, unnest({words('text')}) AS term FROM documents) GROUP BY term),
lang_weights AS (
  SELECT term, {", ".join(
      f"CAST(round(1000000 * ln(({lang} + 1) / "
      f"(SELECT CAST(sum({lang}) + count(*) AS BIGINT) FROM lang_counts))) AS BIGINT) AS {lang}"
      for lang in LANGUAGES)}
  FROM lang_counts),
lang_prior AS (
  SELECT {", ".join(
      f"CAST(round(1000000 * ln((count(*) FILTER (WHERE lang = '{lang}') + 1) / "
      f"(count(*) FILTER (WHERE lang IN ({texts(LANGUAGES)})) + 4))) AS BIGINT) AS {lang}"
      for lang in LANGUAGES)}
  FROM documents),
lang_scores AS (
  SELECT f.item_id, {", ".join(
      f"coalesce(sum(w.{lang}), 0) + (SELECT {lang} FROM lang_prior) AS {lang}"
      for lang in LANGUAGES)}
  FROM feed f LEFT JOIN tokens t USING (item_id) LEFT JOIN lang_weights w USING (term)
  GROUP BY f.item_id),
lang_best AS (
  SELECT item_id, CASE greatest({", ".join(LANGUAGES)})
                    {" ".join(f"WHEN {lang} THEN '{lang}'" for lang in LANGUAGES)} END AS label
  FROM lang_scores)"""
on_feed("classify_terms", "SELECT item_id, topic AS label FROM topic_best", TOKENS,
        listed("topic", TOPICS, "general chatter"))
on_feed("classify_bayes", "SELECT * FROM lang_best", TOKENS, BAYES)
ORACLE["bayes_incremental"] = ORACLE["classify_bayes"]
on_feed("classify_bayes_held_out", """
SELECT f.item_id, label, f.lang FROM lang_best JOIN feed f USING (item_id)
WHERE item_id LIKE 'doc:%' AND TRY_CAST(substr(item_id, 5) AS BIGINT) % 2 = 1""", TOKENS,
        BAYES.replace("FROM documents)", "FROM documents WHERE doc_id % 2 = 0)")
        .replace("FROM documents),", "FROM documents WHERE doc_id % 2 = 0),")
        .replace("FROM documents GROUP", "FROM documents WHERE doc_id % 2 = 0 GROUP")
        .replace("\n  FROM documents)", "\n  FROM documents WHERE doc_id % 2 = 0)"))
on_feed("detect_language", """
SELECT item_id, coalesce(lang, label) AS lang, text FROM feed JOIN lang_best USING (item_id)""",
        TOKENS, BAYES)

ENTITIES = f"""
gazetteer AS (
  SELECT array_to_string(w[4 * k + 1:4 * k + 2 + k % 5], ' ') AS phrase,
         (item_id + k) % 3 AS kind, 'Name ' || item_id || '.' || k AS name
  FROM (SELECT item_id, w, unnest(range(0, (len(w) + 3) // 4)) AS k
        FROM (SELECT item_id, {words('text')} AS w FROM benchmark))),
placed AS (
  SELECT item_id, unnest(w) AS term, unnest(generate_series(1, len(w))) AS pos
  FROM (SELECT item_id, {words('text')} AS w FROM feed)),
windows AS (
  SELECT item_id, pos, term AS w0, {", ".join(f"lead(term, {i}) OVER o AS w{i}" for i in range(1, 6))}
  FROM placed WINDOW o AS (PARTITION BY item_id ORDER BY pos)),
runs AS (
  {" UNION ALL ".join(f"SELECT item_id, pos, {n} AS n, " + " || ' ' || ".join(f"w{i}" for i in range(n))
                      + " AS phrase FROM windows" for n in range(1, 7))}),
ranked AS (
  SELECT item_id, kind, name,
         row_number() OVER (PARTITION BY item_id, kind ORDER BY pos, n DESC, name) AS r
  FROM runs JOIN gazetteer USING (phrase)),
named AS (
  SELECT item_id, max(CASE WHEN kind = 0 THEN name END) AS speaker,
         max(CASE WHEN kind = 1 THEN name END) AS company,
         max(CASE WHEN kind = 2 THEN name END) AS location
  FROM ranked WHERE r = 1 GROUP BY item_id)"""
on_feed("entity_match", "SELECT * FROM named", ENTITIES)

MEMORY = """
memory AS (
  SELECT DISTINCT lang, text FROM documents
  WHERE lang <> 'en' AND doc_id IN (SELECT doc_id FROM labels))"""
on_feed("translate_memory", """
SELECT f.item_id, f.lang,
       CASE WHEN f.lang = 'en' THEN f.text WHEN m.text IS NOT NULL
            THEN 'In English: ' || m.text END AS text_en
FROM feed f LEFT JOIN memory m ON m.lang = f.lang AND m.text = f.text""", MEMORY)
on_feed("translate_pending", """
SELECT lang, sha256(text) AS text_hash, count(*) AS items, text FROM feed f
WHERE (lang IS NULL OR lang <> 'en')
  AND NOT EXISTS (SELECT 1 FROM memory m WHERE m.lang = f.lang AND m.text = f.text)
GROUP BY lang, text""", MEMORY)
on_feed("reply_parse", """
SELECT item_id, CASE WHEN sentiment <> 'mixed' THEN action_bucket END AS bucket,
       CASE WHEN sentiment <> 'mixed' THEN 'Answer ' || author END AS action
FROM feed""")


def rule_case(pick, default: str) -> str:
    cases = []
    for rule in DEFAULT_RULES:
        tests = [f"{name} IN ({texts(values)})" for name, values in
                 (("topic", rule.topics), ("sentiment", rule.sentiments)) if values]
        cases.append(f"WHEN {' AND '.join(tests)} THEN {text(pick(rule))}")
    return f"CASE {' '.join(cases)} ELSE {text(default)} END"


BUCKET = rule_case(lambda r: r.bucket, DEFAULT_BUCKET)
ACTION = rule_case(lambda r: r.action, DEFAULT_ACTION)
on_feed("action_rules", f"SELECT item_id, {BUCKET} AS bucket, {ACTION} AS action FROM feed")
on_feed("infer_batch", """
SELECT item_id, 'monitor' AS bucket, 'Read ' || (length(text) + 6) || ' characters' AS action
FROM feed""")
ORACLE["infer_once_batches"] = ORACLE["infer_batch"]
ENRICHED = f"""
labelled AS (
  SELECT f.* EXCLUDE (lang, sentiment, topic, theme, speaker, company, location, action_bucket),
         coalesce(f.lang, l.label) AS lang, t.sentiment, tb.topic, hb.theme, n.speaker, n.company,
         n.location
  FROM feed f JOIN toned t USING (item_id) JOIN topic_best tb USING (item_id)
  JOIN theme_best hb USING (item_id) JOIN lang_best l USING (item_id)
  LEFT JOIN named n USING (item_id)),
enriched AS (
  SELECT f.*, CASE WHEN f.lang = 'en' THEN f.text WHEN m.text IS NOT NULL
                   THEN 'In English: ' || m.text END AS text_en,
         {BUCKET} AS action_bucket, {ACTION} AS recommended_action
  FROM labelled f LEFT JOIN memory m ON m.lang = f.lang AND m.text = f.text)"""
ENRICH_PARTS = (TOKENS, LEXICON, TONE, listed("topic", TOPICS, "general chatter"),
                listed("theme", THEMES, "other"), BAYES, ENTITIES, MEMORY, ENRICHED)
on_feed("enrich_all", """
SELECT item_id, lang, sentiment, topic, theme, speaker, company, location, text_en, action_bucket,
       recommended_action, text AS original_text
FROM enriched""", *ENRICH_PARTS)

LAYERS_FEED = FEED.replace("feed AS (", "labelled_feed AS (") + """,
feed AS (
  SELECT * REPLACE (CASE WHEN reactions > 5 THEN reactions ELSE 0 END AS reactions,
                    CASE WHEN source <> 'file' THEN lang END AS lang,
                    CASE WHEN source <> 'file' THEN url END AS url,
                    CASE WHEN source <> 'file' THEN author_headline END AS author_headline)
  FROM labelled_feed)"""
ORACLE["all_layers"] = "WITH " + ",".join((LAYERS_FEED, *ENRICH_PARTS)) + """
SELECT item_id, item_type, parent_id, created_at, sentiment, topic, theme, speaker, company,
       location, CAST(reactions AS BIGINT) + comments + reposts AS engagement, author_headline,
       text_en, text AS original_text, action_bucket, recommended_action, url, source
FROM enriched"""

LAYERED = "WITH gold AS (" + ORACLE["all_layers"] + ")"
ORACLE["summary_metrics"] = LAYERED + f"""
SELECT 'theme' AS metric, theme AS key, sentiment, items
FROM ({counted("theme, sentiment")})
UNION ALL SELECT 'hour', CAST({LOCAL_HOUR} AS VARCHAR), sentiment, count(*) FROM gold GROUP BY 2, 3
UNION ALL SELECT 'running', CAST(hour AS VARCHAR), sentiment, cumulative_items
FROM ({running(UTC_HOUR)})
UNION ALL SELECT 'day', CAST(CAST(created_at AS DATE) AS VARCHAR),
                 CAST(max(engagement) AS VARCHAR), CAST(sum(engagement) AS BIGINT)
FROM gold GROUP BY CAST(created_at AS DATE)
UNION ALL SELECT 'top ' || kind, name, CAST(rank AS VARCHAR), items FROM (
    SELECT *, row_number() OVER (PARTITION BY kind ORDER BY items DESC, name) AS rank
    FROM (SELECT kind, name, count(*) AS items
          FROM (SELECT 'speaker' AS kind, speaker AS name FROM gold
                UNION ALL SELECT 'company', company FROM gold
                UNION ALL SELECT 'location', location FROM gold)
          WHERE name IS NOT NULL GROUP BY kind, name)) WHERE rank <= 10
UNION ALL SELECT 'total', NULL, NULL, count(*) FROM gold"""
ORACLE["newest_stored"] = LAYERED + """
SELECT created_at, item_type, sentiment, topic, theme, speaker, company, engagement, action_bucket,
       recommended_action, text_en, original_text, url
FROM gold ORDER BY created_at DESC, item_id LIMIT 50"""
PAYLOAD_FEED = FEED.replace("feed AS (", "labelled_feed AS (") + "," + PAYLOADS.replace(
    "FROM feed", "FROM labelled_feed") + ", feed AS (SELECT p.*, " + ", ".join(
    f"CAST(NULL AS VARCHAR) AS {c}" for c in ("sentiment", "topic", "theme", "action_bucket",
                                              "location", "speaker", "company")) + " FROM (" + (
    ORACLE["payload_items"].partition(PAYLOADS)[2]) + ") p)"
ORACLE["payload_all_layers"] = "WITH " + ",".join((PAYLOAD_FEED, *ENRICH_PARTS)) + (
    ORACLE["all_layers"].partition(ENRICHED)[2])
ORACLE["empty_drop"] = f"""
SELECT CAST(0 AS BIGINT) AS rows, CAST(0 AS BIGINT) AS new_items,
       CAST({len(BRONZE_COLS.split(","))} AS BIGINT) AS columns
FROM (SELECT count(*) FROM documents)"""
ORACLE["two_batches_all_layers"] = ORACLE["stream_all_layers"] = ORACLE["all_layers"]
ORACLE["mixed_runs"] = ORACLE["stream_upsert"]

# ---- quality ------------------------------------------------------------------------------------

on_feed("quality_check", """
SELECT 'null_key' AS rule, CAST(0 AS BIGINT) AS failures
UNION ALL
SELECT 'duplicate_key', (SELECT count(*) - count(DISTINCT item_id) FROM checked)
UNION ALL
SELECT 'orphan_comment', (SELECT count(*) FROM checked
                          WHERE parent_id IS NOT NULL
                            AND parent_id NOT IN (SELECT item_id FROM checked))
UNION ALL
SELECT 'domain_topic', (SELECT count(*) FROM checked WHERE topic = upper(topic))
UNION ALL
SELECT 'domain_' || c, 0
FROM (VALUES ('item_type'), ('sentiment'), ('theme'), ('action_bucket'), ('source')) names(c)""",
        f"""
checked AS (
  SELECT item_id, parent_id, topic FROM feed
  WHERE item_type = 'comment' OR created_at >= {SPLIT}
  UNION ALL
  SELECT item_id, parent_id, upper(topic) FROM feed WHERE source = 'file')""")
on_feed("mask_members", """
SELECT item_id, CASE WHEN source = 'linkedin_api'
                     THEN regexp_replace(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+', '<mail>', 'g')
                     ELSE text END AS text
FROM feed""")
on_feed("comments_with_post", """
SELECT c.item_id, c.parent_id, p.author AS post_author, p.text AS post_text
FROM feed c LEFT JOIN feed p ON p.item_id = c.parent_id AND p.item_type = 'post'
WHERE c.item_type = 'comment'""")

"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

from tallyworks.operators.timeuse import OTHER_PREFIXES, PRIMARY_PREFIXES, WORK_PREFIXES
from tallyworks.plans.tables import (
    BATCHES,
    DOCUMENT_RANGE,
    ITEM_RANGE,
    SPREAD,
    TERMS,
    VOCABULARY,
    WIDE_ACTIVITIES,
    start_centers,
)


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _split(text: str) -> str:
    """Space-separated words, without trailing empty ones."""
    return (
        f"CASE WHEN {text} = '' THEN [''] WHEN rtrim({text}, ' ') = '' THEN [] "
        f"ELSE string_split(rtrim({text}, ' '), ' ') END"
    )


def _tokens(text: str) -> str:
    """The same, but an empty text has no words."""
    return f"CASE WHEN rtrim({text}, ' ') = '' THEN [] ELSE string_split(rtrim({text}, ' '), ' ') END"


def _inside(html: str, tag: str) -> str:
    opening = rf"(?is)<{tag}(?:\s[^>]*)?>"
    return rf"""CASE WHEN regexp_matches({html}, '{opening}')
        THEN regexp_extract({html}, '{opening}(.*?)(?:</{tag}\s*>|\z)', 1) END"""


LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"

MENTIONS = f"""mentions AS (
    SELECT t.term, d.doc_id
    FROM (SELECT unnest({_list(TERMS)}) AS term) t, documents d
    WHERE list_contains(string_split(d.text, ' '), t.term))"""

RANKED = f"WITH {MENTIONS} SELECT term, count(*) AS n FROM mentions GROUP BY term"

CLICKS = """clicks AS (
    SELECT ts, user_id::VARCHAR AS user_id, json_extract_string(props, '$.k')::INT AS item, event_id
    FROM events)"""

SUMMARY = """summary AS (
    SELECT l_orderkey AS case_id,
        CASE WHEN l_linenumber >= 1 AND l_linenumber < 3 THEN 'working' ELSE 'not working' END AS working,
        CASE WHEN l_suppkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex,
        CASE WHEN l_partkey % 60 + 15 BETWEEN 15 AND 22 THEN 'young'
             WHEN l_partkey % 60 + 15 BETWEEN 23 AND 55 THEN 'active' ELSE 'elder' END AS age,
        (l_quantity + l_linenumber) / 60 AS primaryNeeds,
        l_extendedprice / 60 AS work,
        (l_tax + l_discount) / 60 AS other
    FROM lineitem WHERE l_linenumber <= 4)"""

GROUPED = f"""WITH {SUMMARY}
    SELECT working, sex, age, round(avg(primaryNeeds), 1) AS primaryNeeds,
        round(avg(work), 1) AS work, round(avg(other), 1) AS other
    FROM summary GROUP BY working, sex, age ORDER BY working, sex, age"""

ANSWERS = """answers AS (
    SELECT l_orderkey AS qid, l_orderkey * 10 + l_linenumber AS answer_id,
        l_quantity::INT - 25 AS answer_score
    FROM lineitem)"""

PAIRS = f"""{ANSWERS}, pairs AS (
    SELECT o_orderkey AS qid, o_orderpriority AS tag, 0 AS question_score, answer_id, answer_score
    FROM orders JOIN answers ON o_orderkey = qid)"""

VECTORS = f"""{PAIRS}, vectors AS (
    SELECT qid, ((list_position({_list(VOCABULARY)}, tag) - 1) * {SPREAD})::INT AS lx,
        greatest(0, max(answer_score))::INT AS hs
    FROM pairs GROUP BY qid, tag)"""

START = "c0 AS (SELECT * FROM (VALUES {}) AS t(ci, cx, cy, done))".format(
    ", ".join(f"({i}, {x}, {y}, false)" for i, (x, y) in enumerate(start_centers()))
)

SAMPLED_START = """picked AS (
    SELECT lx, hs, qid, md5(concat('42:', qid::VARCHAR)) AS h FROM vectors
    QUALIFY row_number() OVER (PARTITION BY lx ORDER BY md5(concat('42:', qid::VARCHAR)), qid) <= 3),
c0 AS (SELECT (row_number() OVER (ORDER BY lx, h, qid) - 1)::INT AS ci, lx AS cx, hs AS cy,
    false AS done FROM picked)"""

POINTS = "points AS MATERIALIZED (SELECT lx, hs, count(*) AS n FROM vectors GROUP BY lx, hs)"


def _assigned(name: str, rows: str, key: str, centers: str) -> str:
    return f"""{name} AS MATERIALIZED (
    SELECT r.*, c.ci FROM {rows} r, {centers} c
    QUALIFY row_number() OVER (PARTITION BY {key}
        ORDER BY (r.lx - c.cx)::DOUBLE * (r.lx - c.cx) + (r.hs - c.cy)::DOUBLE * (r.hs - c.cy),
        c.ci) = 1)"""


def _round(i: int) -> str:
    """One round of moving centers; once they have settled they stay."""
    return f"""{_assigned(f"a{i}", "points", "r.lx, r.hs", f"c{i - 1}")},
m{i} AS (SELECT ci, sum(lx * n) // sum(n) AS cx, sum(hs * n) // sum(n) AS cy FROM a{i} GROUP BY ci),
k{i} AS MATERIALIZED (SELECT c.ci, c.cx AS ox, c.cy AS oy, coalesce(m.cx, c.cx) AS cx,
    coalesce(m.cy, c.cy) AS cy, c.done FROM c{i - 1} c LEFT JOIN m{i} m USING (ci)),
c{i} AS MATERIALIZED (SELECT ci, CASE WHEN done THEN ox ELSE cx END AS cx,
    CASE WHEN done THEN oy ELSE cy END AS cy,
    done OR (SELECT sum((cx - ox) ** 2 + (cy - oy) ** 2) FROM k{i}) < 20 AS done FROM k{i})"""


ROUNDS = 30
ALL_ROUNDS = ",\n".join(_round(i) for i in range(1, ROUNDS + 1))


def _cluster_summary(centers: str) -> str:
    """CTEs that end in ``clusters``."""
    return f"""{_assigned("members", "vectors", "r.qid", centers)},
labels AS (SELECT ci, lx, n FROM (SELECT ci, lx, count(*) AS n FROM members GROUP BY ci, lx)
    QUALIFY row_number() OVER (PARTITION BY ci ORDER BY n DESC, lx) = 1),
clusters AS (SELECT m.ci, list_extract({_list(VOCABULARY)}, l.lx // {SPREAD} + 1) AS label,
    round(max(l.n) * 100.0::DOUBLE / count(*), 6) AS percent, count(*) AS size,
    trunc(quantile_cont(m.hs, 0.5))::INT AS median
    FROM members m JOIN labels l USING (ci) GROUP BY m.ci, l.lx)"""


DICTIONARY = (
    f"dictionary AS (SELECT DISTINCT word FROM "
    f"(SELECT unnest({_tokens('text')}) AS word FROM benchmark))"
)


def _mentioned_words(source: str, keep: str = "") -> str:
    return f"SELECT {keep}unnest(list_distinct({_tokens('text')})) AS word FROM {source}"


WINDOW_LIST = (
    "string_agg(concat(epoch_us(ts), ':', item), ',' ORDER BY ts, item)"
)

INSIDE_NEWEST = f"""WITH {CLICKS},
    newest AS (SELECT time_bucket(INTERVAL '6 hours', max(ts), TIMESTAMP '1970-01-01')
        + INTERVAL '6 hours' AS stop FROM clicks),
    inside AS (SELECT DISTINCT user_id, ts, item FROM clicks, newest
        WHERE ts >= stop - INTERVAL '1 day' AND ts < stop)"""

NEWEST_WINDOW = f"""{INSIDE_NEWEST}
    SELECT user_id, item // {ITEM_RANGE} AS piece, {WINDOW_LIST} AS clicks FROM inside GROUP BY 1, 2"""

WHOLE_NEWEST_WINDOW = f"""{INSIDE_NEWEST}
    SELECT user_id, 0 AS piece, {WINDOW_LIST} AS clicks FROM inside GROUP BY user_id"""

ITEM_SETS = f"""WITH {CLICKS},
    pairs AS (SELECT DISTINCT user_id, item FROM clicks)
    SELECT user_id, item // {ITEM_RANGE} AS piece, string_agg(item::VARCHAR, ',' ORDER BY item) AS items
    FROM pairs GROUP BY 1, 2"""

WHOLE_ITEM_SETS = f"""WITH {CLICKS},
    pairs AS (SELECT DISTINCT user_id, item FROM clicks)
    SELECT user_id, 0 AS piece, string_agg(item::VARCHAR, ',' ORDER BY item) AS items
    FROM pairs GROUP BY user_id"""

BATCH = f"(event_id * {BATCHES} // (SELECT max(event_id) + 1 FROM events))::INT"


def _runs(closed: str) -> str:
    """Runs of equal windows of an hour every 30 seconds: cut where a pane of 30 seconds comes in or falls out, and each hour."""
    return f"""WITH {CLICKS},
    held AS (SELECT * FROM (SELECT DISTINCT user_id, item // {ITEM_RANGE} AS piece, ts, item,
        epoch_us(ts) // 30000000 AS step FROM clicks) {closed}),
    steps AS (SELECT DISTINCT user_id, piece, step FROM held),
    cuts AS (SELECT DISTINCT user_id, piece,
        unnest([step - 119, step + 1, step // 120 * 120, (step - 119) // 120 * 120]) AS first FROM steps),
    runs AS (SELECT *, least(lead(first) OVER (PARTITION BY user_id, piece ORDER BY first),
        (first // 120 + 1) * 120) - 1 AS last FROM cuts)
    SELECT r.user_id, r.piece, r.first * 30 AS first_start, r.last * 30 AS last_start, {WINDOW_LIST} AS clicks
    FROM runs r JOIN held h ON h.user_id = r.user_id AND h.piece = r.piece
        AND h.step BETWEEN r.first AND r.first + 119
    GROUP BY 1, 2, 3, 4"""


VISITS = f"""WITH {CLICKS},
    opened AS (SELECT *, coalesce(ts - lag(ts) OVER w >= INTERVAL '2 days', true)::INT AS opens FROM clicks
        WINDOW w AS (PARTITION BY user_id, item ORDER BY ts)),
    numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id, item ORDER BY ts) AS visit FROM opened)
    SELECT user_id, item, epoch_us(min(ts)) AS first_seen, epoch_us(max(ts)) AS last_seen,
        epoch_us(max(ts) + INTERVAL '2 days') AS expires, count(*) AS n
    FROM numbered GROUP BY user_id, item, visit
    HAVING max(ts) + INTERVAL '2 days' <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL '10 minutes'"""


def _wide_hours(prefixes: tuple[str, ...], first: int) -> str:
    """Hours of one class of the wide survey: its activities add up over a range of their numbers."""
    numbers = [7 * i + j for i in range(first, first + len(prefixes)) for j in range(WIDE_ACTIVITIES)]
    return f"list_sum(list_transform({numbers}, lambda m: ((o_custkey + m) % 90)::DOUBLE)) / 60"


WIDE = f"""wide AS (
    SELECT o_orderkey AS case_id,
        CASE WHEN o_orderkey % 7 < 2 THEN 'working' ELSE 'not working' END AS working,
        CASE WHEN o_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex,
        CASE WHEN o_custkey % 60 + 15 BETWEEN 15 AND 22 THEN 'young'
             WHEN o_custkey % 60 + 15 BETWEEN 23 AND 55 THEN 'active' ELSE 'elder' END AS age,
        {_wide_hours(PRIMARY_PREFIXES, 0)} AS primaryNeeds,
        {_wide_hours(WORK_PREFIXES, len(PRIMARY_PREFIXES))} AS work,
        {_wide_hours(OTHER_PREFIXES, len(PRIMARY_PREFIXES) + len(WORK_PREFIXES))} AS other
    FROM orders WHERE o_orderkey % 7 <= 3)"""

OFFSETS = """SELECT 'events' AS topic, (user_id % 3)::INT AS partition, min(event_id) AS from_offset,
    max(event_id) + 1 AS until_offset, count(*) AS n FROM events GROUP BY 1, 2"""


def oracle_sql() -> dict[str, str]:
    return {
        "word_count": f"""WITH {LINES}
            SELECT word, count(*) AS n
            FROM (SELECT unnest({_split('line')}) AS word FROM lines) GROUP BY word""",
        "word_count_from_text": f"""WITH {LINES}
            SELECT word, count(*) AS n
            FROM (SELECT unnest({_split('line')}) AS word FROM lines) GROUP BY word""",
        "tokenize_lines": f"WITH {LINES} SELECT doc_id, unnest({_split('line')}) AS word FROM lines",
        "income_by_key": """SELECT o_custkey, round(sum(o_totalprice), 2) AS total,
            count(*) AS months, round(sum(o_totalprice), 2) / count(*) AS average
            FROM orders GROUP BY o_custkey""",
        "income_by_key_struct": """SELECT o_custkey, round(sum(o_totalprice), 2) AS total,
            round(sum(o_totalprice), 2) / count(*) AS average FROM orders GROUP BY o_custkey""",
        "parse_clicks": f"""WITH {CLICKS}
            SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, user_id, item FROM clicks""",
        "parse_postings": """SELECT 1 AS post_type, o_orderkey AS id, NULL::BIGINT AS accepted_answer,
            NULL::BIGINT AS parent_id, 0 AS score, o_orderpriority AS tag FROM orders
            UNION ALL SELECT 2, l_orderkey * 10 + l_linenumber, NULL, l_orderkey,
            l_quantity::INT - 25, NULL FROM lineitem""",
        "parse_articles": """SELECT doc_id, concat('doc ', doc_id::VARCHAR) AS title, text
            FROM documents""",
        "parse_pages": f"""SELECT page_id, {_inside('html', 'title')} AS title,
            {_inside('html', 'body')} AS text FROM pages""",
        "encode_events": f"""WITH {CLICKS}
            SELECT event_id, user_id AS key,
            concat_ws(chr(9), (epoch_us(ts) // 1000)::VARCHAR, user_id, item::VARCHAR) AS value
            FROM clicks""",
        "decode_segments": f"""SELECT conv_id, turn, unnest(list_distinct({_split('text')})) AS word
            FROM conversations WHERE role <> 'system'""",
        "date_buckets": """SELECT strftime(ts, '%Y%m') AS month, strftime(ts, '%Y-%m-%d') AS day,
            count(*) AS n FROM events GROUP BY 1, 2""",
        "docs_mentioning_term": """SELECT count(*) FILTER
            (WHERE list_contains(string_split(text, ' '), 'the')) AS n FROM documents""",
        "rank_terms": RANKED,
        "rank_terms_one_pass": RANKED,
        "rank_terms_from_index": RANKED,
        "term_doc_index": f"WITH {MENTIONS} SELECT term, doc_id FROM mentions",
        "term_postings": f"""WITH {MENTIONS} SELECT term, doc_id // {DOCUMENT_RANGE} AS piece,
            string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS doc_ids
            FROM mentions GROUP BY 1, 2""",
        "life_period_labels": f"""WITH {SUMMARY}
            SELECT working, sex, age, count(*) AS n FROM summary GROUP BY working, sex, age""",
        "time_use_summary": f"""WITH {SUMMARY}
            SELECT case_id, working, sex, age, round(primaryNeeds, 6) AS primaryNeeds,
            round(work, 6) AS work, round(other, 6) AS other FROM summary""",
        "time_use_from_csv": f"""WITH {WIDE}
            SELECT case_id::VARCHAR AS case_id, working, sex, age, round(primaryNeeds, 6) AS primaryNeeds,
            round(work, 6) AS work, round(other, 6) AS other FROM wide""",
        "time_use_from_lines": f"""WITH {WIDE}
            SELECT working, sex, age, round(avg(primaryNeeds), 1) AS primaryNeeds,
            round(avg(work), 1) AS work, round(avg(other), 1) AS other FROM wide
            WHERE case_id % 10 <> 0 GROUP BY working, sex, age ORDER BY working, sex, age""",
        "time_use_grouped": GROUPED,
        "time_use_grouped_sql": GROUPED,
        "time_use_grouped_typed": GROUPED,
        "qa_pairs": f"WITH {PAIRS} SELECT * FROM pairs",
        "qa_grouped": f"WITH {PAIRS} SELECT qid, count(*) AS n_answers FROM pairs GROUP BY qid",
        "qa_answer_lists": f"""WITH {PAIRS} SELECT qid, 0 AS piece,
            array_to_string(list_sort(list(answer_score::VARCHAR)), ',') AS scores
            FROM pairs GROUP BY qid""",
        "best_answer_score": f"""WITH {PAIRS} SELECT qid, tag,
            greatest(0, max(answer_score)) AS high_score FROM pairs GROUP BY qid, tag""",
        "feature_vectors": f"WITH {VECTORS} SELECT qid, lx, hs FROM vectors",
        "vectors_from_postings": f"WITH {VECTORS} SELECT qid, lx, hs FROM vectors",
        "stratified_sample": f"""WITH {VECTORS} SELECT qid, lx, hs FROM vectors
            QUALIFY row_number() OVER
            (PARTITION BY lx ORDER BY md5(concat('42:', qid::VARCHAR)), qid) <= 3""",
        "uniform_sample": f"""WITH {VECTORS} SELECT qid, lx, hs FROM vectors
            ORDER BY md5(concat('42:', qid::VARCHAR)), qid LIMIT 15""",
        "kmeans_assign": f"""WITH {VECTORS}, {START}, {_assigned("members", "vectors", "r.qid", "c0")}
            SELECT qid, lx, hs, ci FROM members""",
        "kmeans_step": f"""WITH {VECTORS}, {POINTS}, {START},
            {_assigned("members", "points", "r.lx, r.hs", "c0")}
            SELECT ci, (sum(lx * n) // sum(n))::INT AS cx, (sum(hs * n) // sum(n))::INT AS cy,
            sum(n)::BIGINT AS size FROM members GROUP BY ci""",
        "kmeans_fit": f"""WITH {VECTORS}, {POINTS}, {START}, {ALL_ROUNDS}
            SELECT ci, cx::INT AS cx, cy::INT AS cy FROM c{ROUNDS}""",
        "group_median": f"""WITH {VECTORS}
            SELECT lx, trunc(quantile_cont(hs, 0.5))::INT AS median FROM vectors GROUP BY lx""",
        "group_median_sketched": """SELECT l_returnflag, l_linestatus, count(*) AS n,
            trunc(quantile_cont(round(l_extendedprice * 100)::INT, 0.5))::INT AS median, TRUE AS within_bound
            FROM lineitem GROUP BY l_returnflag, l_linestatus""",
        "cluster_summary": f"""WITH {VECTORS}, {START}, {_cluster_summary("c0")}
            SELECT ci, label, percent, size, median FROM clusters""",
        "posting_clusters": f"""WITH {VECTORS}, {POINTS}, {SAMPLED_START}, {ALL_ROUNDS},
            {_cluster_summary(f"c{ROUNDS}")}
            SELECT ci, label, percent, size, median FROM clusters""",
        "cluster_report": f"""WITH {VECTORS}, {START}, {_cluster_summary("c0")}
            SELECT median, ci,
            printf('%7d  %-17s (%-5.1f%%)      %7d', median, label, percent, size) AS line
            FROM clusters""",
        "dictionary_words": f"WITH {DICTIONARY} SELECT word FROM dictionary",
        "dictionary_hits": f"""WITH {DICTIONARY},
            found AS ({_mentioned_words("documents", "doc_id, ")})
            SELECT doc_id, word FROM found JOIN dictionary USING (word)""",
        "dictionary_counts": f"""WITH {DICTIONARY}, found AS ({_mentioned_words("documents")})
            SELECT word, count(*) AS n FROM found JOIN dictionary USING (word) GROUP BY word""",
        "word_upsert": f"""WITH {DICTIONARY}, found AS (
            {_mentioned_words("documents")} UNION ALL {_mentioned_words("conversations")})
            SELECT word, '2024-01-15' AS date, count(*) AS n
            FROM found JOIN dictionary USING (word) GROUP BY word""",
        "offset_ranges": OFFSETS,
        "record_log": """SELECT event_id AS offset, user_id::VARCHAR AS key, event_type AS value
            FROM events""",
        "user_item_sets": WHOLE_ITEM_SETS,
        "user_item_windows": f"""WITH {CLICKS},
            placed AS (SELECT DISTINCT user_id, ts, item,
                time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01')
                - i * INTERVAL '6 hours' AS window_start
                FROM clicks, range(4) AS steps(i))
            SELECT user_id, epoch(window_start)::BIGINT AS window_start, item // {ITEM_RANGE} AS piece,
            {WINDOW_LIST} AS clicks FROM placed GROUP BY 1, 2, 3""",
        "user_item_runs": _runs(""),
        "stream_item_runs": _runs(
            "WHERE (step + 1) * 30000000 <= (SELECT epoch_ms(max(ts)) * 1000 FROM events) - 600000000"
        ),
        "stream_item_visits": VISITS,
        "stream_replayed_offsets": f"""WITH dense AS (
            SELECT {BATCH} AS batch, (event_id % 3)::INT AS partition, event_id // 3 AS place FROM events)
            SELECT batch, 'events' AS topic, partition, min(place) AS from_offset,
            max(place) + 1 AS until_offset, count(*) AS n, true AS follows FROM dense GROUP BY batch, partition""",
        "stream_dictionary_versions": f"""WITH ends AS (
            SELECT min(event_type) AS first, max(event_type) AS last FROM events)
            SELECT event_type AS word, strftime(ts, '%Y-%m-%d') AS date, count(*) AS n FROM events, ends
            WHERE CASE {BATCH} WHEN 0 THEN event_type <> first WHEN 1 THEN event_type <> last
                ELSE event_type = first END
            GROUP BY 1, 2""",
        "word_table_compacted": """SELECT event_type AS word,
            strftime(ts::DATE + (user_id % 2 * 31)::INT, '%Y-%m-%d') AS date, count(*) AS n
            FROM events GROUP BY 1, 2""",
        "user_item_window_at": NEWEST_WINDOW,
        "stream_user_item_sets": ITEM_SETS,
        "stream_item_window_at": WHOLE_NEWEST_WINDOW,
        "stream_offset_ranges": OFFSETS,
        "stream_word_frequency": """SELECT event_type AS word, strftime(ts, '%Y-%m-%d') AS date,
            count(*) AS n FROM events WHERE event_type > (SELECT min(event_type) FROM events)
            GROUP BY 1, 2""",
    }

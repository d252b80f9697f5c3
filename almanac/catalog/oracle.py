"""The same queries in SQL, for comparison on the driver's tables."""

from __future__ import annotations

from almanac.catalog.tables import LEMMAS, LEXICON, NEWS_DAYS, NEWS_SITE
from almanac.functions.text import CHUNK_TOKENS, WORD_PATTERN, html_rules
from almanac.operators.summary import SUMMARY_SENTENCES
from almanac.schemas import CORRELATION_COLUMNS, SENTIMENT_COLUMNS

SERIES_FIELDS = ["price", "lagged_price", "returns", "3d_rolling_volatility", "7d_rolling_volatility", "future_returns"]


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


def _r(*columns: str, digits: int = 6) -> str:
    return ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in columns)


def _news(days: int = 30, start: str = "2024-01-01") -> str:
    return f"""news AS (
        SELECT doc_id, split_part(text, chr(10), 1) AS titles, '{NEWS_SITE}' || doc_id AS url,
               DATE '{start}' + CAST(doc_id % {days} AS INTEGER) AS time_published, text AS content
        FROM documents)"""


def _prices(stamp: str, amount: str, source: str) -> str:
    return f"""prices AS (
    SELECT CAST({stamp} AS DATE) AS date, CAST(sum(CAST({amount} AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS price
    FROM {source} GROUP BY 1)"""


EVENT_PRICES = _prices("ts", "value", "events")
ORDER_PRICES = f"""{_prices("o_orderdate", "o_totalprice", "orders").replace("prices AS", "means AS")},
prices AS (SELECT date, round_even(price * 100, 0) / 100 AS price FROM means)"""
RAW = """raw AS (
    SELECT news.*, round_even(price * 100, 0) / 100 AS price FROM news JOIN prices ON time_published = date)"""
ORDER_DAYS = "days AS (SELECT date AS time_published, price FROM prices)"
RAW_DAYS = "days AS (SELECT time_published, avg(price) AS price FROM raw GROUP BY 1)"


def _series(source: str = "days") -> str:
    return f"""filled AS (
        SELECT *, last_value(price IGNORE NULLS) OVER (ORDER BY time_published
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p FROM {source}),
    returned AS (
        SELECT time_published, price, CAST(isodow(time_published) - 1 AS INTEGER) AS day_of_week,
               lag(price) OVER (ORDER BY time_published) AS lagged_price,
               p / nullif(lag(p) OVER (ORDER BY time_published), 0) - 1 AS returns FROM filled),
    series AS (
        SELECT *,
            CASE WHEN count(returns) OVER w3 >= 3 THEN stddev_samp(returns) OVER w3 END AS "3d_rolling_volatility",
            CASE WHEN count(returns) OVER w7 >= 7 THEN stddev_samp(returns) OVER w7 END AS "7d_rolling_volatility",
            lead(returns) OVER (ORDER BY time_published) AS future_returns
        FROM returned
        WINDOW w3 AS (ORDER BY time_published ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
               w7 AS (ORDER BY time_published ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""


ORDER_SERIES = f"{ORDER_PRICES}, {ORDER_DAYS}, {_series()}"


def _tokens(column: str) -> str:
    return f"regexp_extract_all(lower({column}), '{WORD_PATTERN}')"


LEXICON_CTE = f"lexicon(token, neg, pos) AS (SELECT token, CAST(neg AS DOUBLE), CAST(pos AS DOUBLE) FROM (VALUES {_values(LEXICON)}) v(token, neg, pos))"
LEMMA_CTE = f"lemmas(token, lemma) AS (VALUES {_values(LEMMAS)})"


def _statistics(key: str) -> str:
    """Needs words(key, chunk, token)."""
    return f"""{LEXICON_CTE}, scored AS (
        SELECT {key}, chunk, coalesce(sum(neg), 0) / count(*) AS neg, coalesce(sum(pos), 0) / count(*) AS pos
        FROM words LEFT JOIN lexicon USING (token) GROUP BY {key}, chunk),
    stats AS (
        SELECT {key}, avg(neg) AS mean_neg_sentiment, max(neg) AS max_neg_sentiment, min(neg) AS min_neg_sentiment,
               stddev_pop(neg) AS std_neg_sentiment, avg(pos) AS mean_pos_sentiment, max(pos) AS max_pos_sentiment,
               min(pos) AS min_pos_sentiment, stddev_pop(pos) AS std_pos_sentiment,
               count(*) AS n_chunks, CAST(0 AS BIGINT) AS n_failed
        FROM scored GROUP BY {key})"""


DOC_WORDS = f"""spread AS (
    SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos
    FROM (SELECT doc_id, {_tokens('text')} AS toks FROM documents)),
words AS (SELECT doc_id, token, (pos - 1) // {CHUNK_TOKENS} AS chunk FROM spread)"""

DAY_WORDS = f"""spread AS (
    SELECT time_published, doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos
    FROM (SELECT time_published, doc_id, {_tokens('content')} AS toks FROM raw)),
words AS (
    SELECT time_published, token,
           (row_number() OVER (PARTITION BY time_published ORDER BY doc_id, pos) - 1) // {CHUNK_TOKENS} AS chunk
    FROM spread)"""


def _class(value: str, mean: str, std: str) -> str:
    return (
        f"CASE WHEN {value} > {mean} + {std} THEN 'pos_return' "
        f"WHEN {value} < {mean} - {std} THEN 'neg_return' ELSE 'mod_return' END"
    )


def _html() -> str:
    out = "html"
    for pattern, replacement in html_rules():
        flags = "g"
        if pattern.startswith("(?"):
            flags += pattern[2:pattern.index(")")]
            pattern = pattern[pattern.index(")") + 1:]
        pattern, replacement = pattern.replace("'", "''"), replacement.replace("'", "''")
        out = f"regexp_replace({out}, '{pattern}', '{replacement}', '{flags}')"
    return f"trim({out})"


def _stamp(expr: str, form: str = "%Y%m%dT%H%M%S") -> str:
    return f"strftime({expr}, '{form}')"


CLOCK = "printf('%02d%02d%02d', (doc_id % 86400) // 3600, ((doc_id % 86400) // 60) % 60, doc_id % 60)"

INGEST = f"""WITH {_news()}, {EVENT_PRICES}, {RAW},
    stamped AS (SELECT *, strftime(time_published, '%Y%m%d') || 'T' || {CLOCK} AS published_at FROM raw),
    firsts AS (
        SELECT *, row_number() OVER (PARTITION BY titles ORDER BY published_at, url) AS place FROM stamped)
    SELECT titles, f.url, time_published, round_even(price * 100, 0) / 100 AS price, md5({_html()}) AS content, published_at
    FROM firsts f JOIN pages ON f.url = '{NEWS_SITE}' || page_id WHERE place = 1"""

LATE_INGEST = f"""WITH {_news()}, {EVENT_PRICES}, {RAW},
    stamped AS (
        SELECT *, strftime(time_published, '%Y%m%d') || 'T' || {CLOCK} AS published_at, doc_id % 30 < 10 AS late FROM raw),
    firsts AS (
        SELECT *, row_number() OVER (PARTITION BY late, titles ORDER BY published_at, url) AS place FROM stamped),
    paged AS (
        SELECT titles, f.url, time_published, price, html, published_at, late
        FROM firsts f JOIN pages ON f.url = '{NEWS_SITE}' || page_id WHERE place = 1),
    stored AS (
        SELECT * FROM paged WHERE NOT late
        UNION ALL SELECT * FROM paged p WHERE late AND NOT EXISTS (
            SELECT 1 FROM paged q WHERE NOT q.late AND q.titles IS NOT DISTINCT FROM p.titles))
    SELECT titles, url, time_published, round_even(price * 100, 0) / 100 AS price, md5({_html()}) AS content, published_at
    FROM stored"""

SQUARINGS = 20


def _components(days: str, counts: str, day: str = "time_published") -> str:
    """CTEs that end in components(day, PCA1, PCA2), from the days of one table and (day, token, tf) of another.

    The centred Gram matrix of the days, divided by its trace and squared over and over, turns into the projector on
    its leading eigenvector; taken off, the next one follows.
    """
    def leading(source: str, n: int) -> str:
        steps = [f"p{n}_0 AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FROM {source} WHERE i = j) AS v FROM {source})"]
        for k in range(SQUARINGS):
            steps.append(f"""q{n}_{k} AS MATERIALIZED (
                SELECT a.i, b.j, sum(a.v * b.v) AS v FROM p{n}_{k} a JOIN p{n}_{k} b ON a.j = b.i GROUP BY a.i, b.j),
            p{n}_{k + 1} AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FROM q{n}_{k} WHERE i = j) AS v FROM q{n}_{k})""")
        last = f"p{n}_{SQUARINGS}"
        steps.append(f"""value{n} AS (SELECT sum(g.v * p.v) AS v FROM {source} g JOIN {last} p USING (i, j)),
            pivot{n} AS (SELECT i, v FROM {last} WHERE i = j ORDER BY v DESC LIMIT 1),
            score{n} AS (
                SELECT p.i, p.v / sqrt(t.v) * sqrt(l.v) AS s FROM {last} p JOIN pivot{n} t ON p.j = t.i, value{n} l)""")
        return ",\n".join(steps)

    return f"""day_list AS (SELECT DISTINCT {day} AS i FROM {days}),
        frequency AS (
            SELECT token, ln((1.0::DOUBLE + (SELECT count(*) FROM day_list)) / (1.0::DOUBLE + count(*))) + 1 AS idf
            FROM {counts} GROUP BY token),
        heavy AS (SELECT {day} AS i, token, tf * idf AS w FROM {counts} JOIN frequency USING (token)),
        unit AS (SELECT i, token, w / sqrt(sum(w * w) OVER (PARTITION BY i)) AS w FROM heavy),
        met AS (SELECT a.i, b.i AS j, sum(a.w * b.w) AS v FROM unit a JOIN unit b USING (token) GROUP BY a.i, b.i),
        whole AS (
            SELECT a.i, b.i AS j, coalesce(v, 0) AS v
            FROM day_list a CROSS JOIN day_list b LEFT JOIN met ON met.i = a.i AND met.j = b.i),
        gram AS MATERIALIZED (
            SELECT i, j, v - avg(v) OVER (PARTITION BY i) - avg(v) OVER (PARTITION BY j) + avg(v) OVER () AS v FROM whole),
        {leading("gram", 1)},
        rest AS MATERIALIZED (SELECT i, j, g.v - l.v * p.v AS v FROM gram g JOIN p1_{SQUARINGS} p USING (i, j), value1 l),
        {leading("rest", 2)},
        components AS (SELECT i AS {day}, a.s AS "PCA1", b.s AS "PCA2" FROM score1 a JOIN score2 b USING (i))"""


def _day_counts(lemmas: bool) -> str:
    """day_counts(time_published, token, tf) of raw, as lemmas where wanted (needs lemmas)."""
    named = "coalesce(lemma, token)" if lemmas else "token"
    return f"""day_counts AS (
            SELECT time_published, {named} AS token, count(*) AS tf
            FROM (SELECT time_published, unnest({_tokens("coalesce(titles, '') || ' ' || coalesce(content, '')")}) AS token FROM raw)
            {"LEFT JOIN lemmas USING (token)" if lemmas else ""} WHERE length({named}) >= 2 GROUP BY 1, 2)"""


def _model_rows() -> str:
    """Days that train and test the classifier, as rows(time_published, future_returns, is_train)."""
    return f"""{_news(NEWS_DAYS, "1995-01-01")}, {ORDER_PRICES}, {RAW}, {RAW_DAYS}, {_series()}, {DAY_WORDS},
        placed AS (SELECT *, row_number() OVER (ORDER BY time_published) AS place, count(*) OVER () AS total FROM series),
        known AS (
            SELECT time_published, future_returns FROM placed
            WHERE place > 1 AND place < total AND future_returns IS NOT NULL AND returns IS NOT NULL
              AND lagged_price IS NOT NULL AND time_published >= (SELECT min(time_published) FROM words)),
        again AS (SELECT *, row_number() OVER (ORDER BY time_published) AS position, count(*) OVER () AS n FROM known),
        split AS (SELECT *, position <= n - ceil(round(n * 0.1::DOUBLE, 9)) AS is_train FROM again),
        band AS (SELECT avg(future_returns) AS m, stddev_samp(future_returns) AS s FROM split WHERE is_train),
        classed AS (SELECT *, {_class("future_returns", "m", "s")} AS return_class FROM split, band),
        coded AS (SELECT *, CAST(dense_rank() OVER (ORDER BY return_class) - 1 AS INTEGER) AS return_class_encoded FROM classed)"""


SENTENCES = r"""pieces AS (
    SELECT doc_id, list_filter(list_transform(
        string_split(regexp_replace(text, '([.!?])[ \t\n\f\r]+', '\1' || chr(10), 'g'), chr(10)),
        lambda s: trim(s)), lambda s: length(s) > 0) AS sents FROM documents)"""

SUMMARY = f"""{SENTENCES},
    sentence AS (SELECT doc_id, unnest(sents) AS sentence, generate_subscripts(sents, 1) - 1 AS pos FROM pieces),
    found AS (SELECT doc_id, pos, unnest({_tokens('sentence')}) AS token FROM sentence),
    counts AS (SELECT doc_id, pos, token, count(*) AS n FROM found WHERE length(token) >= 2 GROUP BY ALL),
    doc_counts AS (SELECT doc_id, token, sum(n) AS tf FROM counts GROUP BY ALL),
    idf AS (
        SELECT token, ln((1.0::DOUBLE + (SELECT count(*) FROM documents)) / (1.0::DOUBLE + count(*))) + 1 AS idf
        FROM doc_counts GROUP BY token),
    weights AS (SELECT doc_id, token, tf * idf AS w FROM doc_counts JOIN idf USING (token)),
    norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM weights GROUP BY doc_id),
    scores AS (
        SELECT doc_id, pos, sum(w / norm * n) / sum(n) AS score
        FROM counts JOIN weights USING (doc_id, token) JOIN norms USING (doc_id) GROUP BY doc_id, pos),
    ranked AS (
        SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, pos) AS place
        FROM scores),
    summaries AS (
        SELECT doc_id, string_agg(sentence, ' ' ORDER BY pos) AS summary
        FROM ranked JOIN sentence USING (doc_id, pos) WHERE place <= {SUMMARY_SENTENCES} GROUP BY doc_id)"""

PAIRS = f"""{ORDER_SERIES}, known AS (
        SELECT *, avg(future_returns) OVER () AS fm, stddev_samp(future_returns) OVER () AS fs,
               avg(returns) OVER () AS rm, stddev_samp(returns) OVER () AS rs
        FROM series WHERE future_returns IS NOT NULL AND returns IS NOT NULL),
    pairs AS (
        SELECT {_class('future_returns', 'fm', 'fs')} AS actual, {_class('returns', 'rm', 'rs')} AS guess FROM known)"""

CORRELATED = ["price", "day_of_week", "returns", "3d_rolling_volatility", "7d_rolling_volatility", "future_returns"]


def queries() -> dict[str, str]:
    sql = {}
    sql["daily_series_flagship"] = f"""WITH {_news()}, {EVENT_PRICES}, {RAW},
        firsts AS (SELECT *, row_number() OVER (PARTITION BY titles ORDER BY doc_id) AS place FROM raw),
        kept AS (SELECT * FROM firsts WHERE place = 1),
        days AS (SELECT time_published, avg(price) AS price, md5(string_agg(titles, ' ' ORDER BY doc_id)) AS titles,
                        md5(string_agg(content, ' ' ORDER BY doc_id)) AS content FROM kept GROUP BY 1),
        {_series()}
        SELECT time_published, titles, content, day_of_week, {_r(*SERIES_FIELDS)}
        FROM series JOIN (SELECT time_published, titles, content FROM days) USING (time_published)"""
    sql["scan_projection"] = "SELECT doc_id, lang AS language, n_chars FROM documents"
    sql["pipeline_ingest"] = INGEST
    sql["append_roundtrip"] = INGEST
    sql["late_page_ingest"] = INGEST
    sql["late_item_ingest"] = LATE_INGEST
    sql["bucketed_anti_join"] = "SELECT event_id, event_type FROM events WHERE event_id % 3 = 2"
    sql["stream_late_items"] = f"""WITH {_news()}, firsts AS (
            SELECT doc_id, time_published, content, row_number() OVER (
                PARTITION BY content ORDER BY (doc_id % 30) // 10 DESC, doc_id) AS place FROM news)
        SELECT doc_id, CAST(time_published AS TIMESTAMP) AS published, md5(content) AS titles FROM firsts WHERE place = 1"""
    sql["rejected_stamps"] = f"""WITH {_news()}
        SELECT url, 'day ' || strftime(time_published, '%Y%m%d') || 'T' || strftime(
                   TIMESTAMP '2024-01-01' + to_seconds(doc_id % 86400), '%H%M%S') AS time_published, md5(titles) AS titles
        FROM news WHERE doc_id % 2 = 1"""
    sql["price_revision"] = """SELECT CAST(o_orderdate AS DATE) AS date, arg_max(o_totalprice, o_orderkey) AS price
        FROM orders GROUP BY 1"""
    sql["repeated_items_sentiment"] = f"""WITH {_news()}, {EVENT_PRICES}, {RAW},
        sizes AS (SELECT time_published, 2 * sum(len({_tokens('content')})) AS n FROM raw GROUP BY 1)
        SELECT time_published, CAST(ceil(n / {CHUNK_TOKENS}.0) AS BIGINT) AS n_chunks, CAST(n AS BIGINT) AS n_words
        FROM sizes WHERE n > 0"""
    sql["stream_restart"] = "SELECT md5(text) AS titles, CAST(1 AS BIGINT) AS copies FROM documents GROUP BY text"
    sql["replace_roundtrip"] = f"""WITH {_news()}, {EVENT_PRICES}, {RAW}, {RAW_DAYS}, {_series()}
        SELECT time_published, day_of_week, {_r(*SERIES_FIELDS)} FROM series"""
    sql["high_water_mark"] = f"""SELECT max(CAST(ts AS DATE)) AS latest,
        {_stamp('max(CAST(ts AS DATE))', '%Y%m%dT%H%M')} AS cursor,
        substr({_stamp('max(ts)')}, 1, 9) || '0000' AS page_cursor FROM events"""
    sql["feed_flatten"] = f"""WITH {_news()}, lines AS (
            SELECT url, time_published, string_split(content, chr(10)) AS parts FROM news),
        entries AS (SELECT url, time_published, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS i FROM lines)
        SELECT md5(line) AS titles, url || '#' || i AS url, strftime(time_published, '%Y%m%d') AS time_published
        FROM entries"""
    sql["price_map_flatten"] = "SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS price FROM orders"
    sql["json_snapshot"] = """WITH read AS (
            SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS value, event_type AS value_text FROM events)
        SELECT *, CASE WHEN value >= 70 THEN 'red' WHEN value > 40 AND value < 70 THEN 'yellow' ELSE 'green' END
            AS colour FROM read"""
    sql["incremental_poll"] = f"""WITH bound AS (SELECT max(CAST(ts AS DATE)) AS day FROM events)
        SELECT event_id, {_stamp('ts')} AS time_published FROM events, bound
        WHERE ts >= CAST(day AS TIMESTAMP) + INTERVAL 12 HOUR"""
    sql["feed_page"] = f"""SELECT event_id, {_stamp('ts')} AS time_published FROM events
        ORDER BY 2, 1 LIMIT 1000"""
    sql["compact_date_parse"] = """SELECT event_id, CAST(ts AS DATE) AS from_seconds, CAST(ts AS DATE) AS from_minutes,
        CAST(ts AS DATE) AS from_day, CAST(NULL AS DATE) AS from_junk, CAST(ts AS DATE) AS from_iso,
        CAST(ts AS DATE) AS from_timestamp FROM events"""
    sql["round_price"] = """SELECT l_orderkey, l_linenumber, round_even(l_extendedprice / l_quantity * 100, 0) / 100 AS price
        FROM lineitem"""
    sql["dedupe_keep_first"] = """SELECT doc_id, md5(text) AS titles FROM (
            SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS place FROM documents) WHERE place = 1"""
    sql["drop_null_content"] = f"""WITH {_news()}
        SELECT doc_id, md5(titles || ' ' || content) AS combined, coalesce(CAST(toxic AS VARCHAR), '') AS toxic
        FROM news JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND content IS NOT NULL"""
    sql["news_price_join"] = f"""WITH {_news()}, {EVENT_PRICES}, {RAW}
        SELECT doc_id, time_published, {_r('price')} FROM raw"""
    sql["daily_text_rollup"] = f"""WITH {_news()}, {EVENT_PRICES}, {RAW}
        SELECT time_published, length(string_agg(content, ' ' ORDER BY doc_id)) AS n_chars,
               md5(string_agg(titles, ' ' ORDER BY doc_id)) AS titles,
               md5(string_agg(content, ' ' ORDER BY doc_id)) AS content, round(avg(price), 6) AS price
        FROM raw GROUP BY time_published"""
    sql["lag_lead_returns"] = f"""WITH {ORDER_SERIES}
        SELECT time_published, day_of_week, {_r('lagged_price', 'returns', 'future_returns')} FROM series"""
    sql["rolling_volatility"] = f"""WITH {ORDER_SERIES}
        SELECT time_published, {_r('3d_rolling_volatility', '7d_rolling_volatility')} FROM series"""
    sql["rolling_means"] = f"""WITH {ORDER_SERIES}, rolled AS (
            SELECT time_published, CASE WHEN count(future_returns) OVER w >= 10 THEN avg(future_returns) OVER w END
                AS rolling_mean FROM series
            WINDOW w AS (ORDER BY time_published ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
        SELECT time_published, {_r('rolling_mean')}, (SELECT round(avg(rolling_mean), 4) FROM rolled) AS overall_mean
        FROM rolled"""
    sql["price_vs_spread"] = f"""WITH {_news(NEWS_DAYS, '1995-01-01')}, {ORDER_PRICES}, {RAW}, {RAW_DAYS}, {DAY_WORDS},
        {_statistics('time_published')}, spreads AS (
            SELECT time_published, price, mean_pos_sentiment - mean_neg_sentiment AS d
            FROM days LEFT JOIN stats USING (time_published))
        SELECT time_published, {_r('price')}, round(CASE WHEN count(d) OVER w >= 30 THEN avg(d) OVER w END, 6) AS spread
        FROM spreads WINDOW w AS (ORDER BY time_published ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""
    pairs = " UNION ALL ".join(
        f"""SELECT '{a}' AS column_a, '{b}' AS column_b, round({'1.0::DOUBLE' if a == b else f'corr("{a}", "{b}")'}, 6)
            AS correlation FROM series {'LIMIT 1' if a == b else ''}""".join(("(", ")"))
        for a in CORRELATED for b in CORRELATED
    )
    sql["correlation_long"] = f"WITH {ORDER_SERIES} {pairs}"
    sql["return_classes"] = f"""WITH {ORDER_SERIES}, classed AS (
            SELECT time_published, {_class('future_returns', 'avg(future_returns) OVER ()',
                                           'stddev_samp(future_returns) OVER ()')} AS return_class FROM series)
        SELECT *, CAST(dense_rank() OVER (ORDER BY return_class) - 1 AS INTEGER) AS return_class_encoded FROM classed"""
    sql["edge_trim_and_split"] = f"""WITH {ORDER_SERIES}, placed AS (
            SELECT *, row_number() OVER (ORDER BY time_published) AS place, count(*) OVER () AS total FROM series),
        inner_rows AS (SELECT * FROM placed WHERE place > 1 AND place < total AND future_returns IS NOT NULL),
        again AS (
            SELECT time_published, row_number() OVER (ORDER BY time_published) AS position, count(*) OVER () AS n
            FROM inner_rows)
        SELECT time_published, position, position <= n - ceil(round(n * 0.1::DOUBLE, 9)) AS is_train FROM again"""
    sql["expanding_folds"] = f"""WITH {ORDER_PRICES}, placed AS (
            SELECT date AS time_published, row_number() OVER (ORDER BY date) AS position, count(*) OVER () AS n FROM prices)
        SELECT time_published, CASE WHEN position > n - 3 * (n // 4)
            THEN CAST((position - 1 - (n - 3 * (n // 4))) // (n // 4) AS INTEGER) END AS test_fold FROM placed"""
    sql["class_report"] = f"""WITH {PAIRS},
        classes AS (SELECT DISTINCT actual AS class FROM pairs UNION SELECT DISTINCT guess FROM pairs),
        counted AS (
            SELECT class, (SELECT count(*) FROM pairs WHERE actual = class) AS support,
                   (SELECT count(*) FROM pairs WHERE actual = class AND guess = class) AS hits,
                   (SELECT count(*) FROM pairs WHERE guess = class) AS guesses FROM classes),
        rates AS (
            SELECT class, coalesce(hits / nullif(guesses, 0), 0) AS precision, coalesce(hits / nullif(support, 0), 0) AS recall,
                   coalesce(2 * hits / nullif(support + guesses, 0), 0) AS f1, support, hits FROM counted),
        lines AS (
            SELECT class, precision, recall, f1, CAST(support AS BIGINT) AS support FROM rates
            UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM rates
            UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM rates
            UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support),
                CAST(sum(support) AS BIGINT) FROM rates)
        SELECT class, support, {_r('precision', 'recall', 'f1')} FROM lines"""
    errors = """round(sqrt(avg((future_returns - returns) ** 2)), 6) AS rmse,
        round(avg(abs((future_returns - returns) / nullif(future_returns, 0))) * 100, 6) AS mape,
        count(*) FILTER (future_returns = 0) AS zero_actuals, count(*) AS n"""
    both = "WHERE future_returns IS NOT NULL AND returns IS NOT NULL"
    sql["regression_metrics"] = f"""WITH {ORDER_SERIES}
        SELECT {errors}, round(avg(abs(future_returns - returns)), 6) AS mae FROM series {both}"""
    sql["naive_baseline"] = f"WITH {ORDER_SERIES} SELECT {errors} FROM series {both}"
    sql["directional_accuracy"] = f"""WITH {ORDER_SERIES}, moved AS (
            SELECT *, future_returns - lag(future_returns) OVER (ORDER BY time_published) AS dy,
                   returns - lag(returns) OVER (ORDER BY time_published) AS dp FROM series {both})
        SELECT round(avg(CAST(sign(dy) = sign(dp) AS DOUBLE)) * 100, 6) AS direction_of_change,
               round(avg(CAST(sign(future_returns) = sign(returns) AS DOUBLE)) * 100, 6) AS direction_of_level
        FROM moved"""
    sql["latest_day"] = f"""WITH {ORDER_SERIES}
        SELECT time_published, {_r('price', 'returns')}, CAST(time_published + 1 AS DATE) AS next_day,
               round(returns * 100, 3) AS percent FROM series ORDER BY time_published DESC LIMIT 1"""
    sql["stream_ingest"] = sql["dedupe_keep_first"]
    sql["stream_first_seen"] = "SELECT DISTINCT md5(text) AS titles FROM documents"

    sql["sentiment_model"] = f"""WITH {DOC_WORDS},
        judged AS (SELECT doc_id, quality AS y FROM documents JOIN labels USING (doc_id) WHERE quality IN (0, 1)),
        counts AS (
            SELECT token, count(*) FILTER (y = 0) AS n0, count(*) FILTER (y = 1) AS n1
            FROM words JOIN judged USING (doc_id) GROUP BY token HAVING count(*) >= 2),
        totals AS (SELECT count(*) AS v, sum(n0) AS t0, sum(n1) AS t1 FROM counts),
        prior AS (SELECT ln((count(*) FILTER (y = 1) + 1.0::DOUBLE) / (count(*) FILTER (y = 0) + 1.0::DOUBLE)) AS p FROM judged),
        weights AS (SELECT token, ln((n1 + 1.0::DOUBLE) / (t1 + v)) - ln((n0 + 1.0::DOUBLE) / (t0 + v)) AS w FROM counts, totals),
        odds AS (
            SELECT doc_id, chunk, coalesce(sum(w), 0) + any_value(p) AS o
            FROM words LEFT JOIN weights USING (token), prior GROUP BY doc_id, chunk),
        scored AS (SELECT doc_id, 1 / (1 + exp(o)) AS neg, 1 / (1 + exp(-o)) AS pos FROM odds),
        stats AS (
            SELECT doc_id, avg(neg) AS mean_neg_sentiment, max(neg) AS max_neg_sentiment, min(neg) AS min_neg_sentiment,
                   stddev_pop(neg) AS std_neg_sentiment, avg(pos) AS mean_pos_sentiment, max(pos) AS max_pos_sentiment,
                   min(pos) AS min_pos_sentiment, stddev_pop(pos) AS std_pos_sentiment, count(*) AS n_chunks
            FROM scored GROUP BY doc_id)
        SELECT doc_id, {_r(*SENTIMENT_COLUMNS)}, coalesce(n_chunks, 0) AS n_chunks, CAST(0 AS BIGINT) AS n_failed
        FROM documents LEFT JOIN stats USING (doc_id)"""
    sql["tfidf_pca2"] = f"""WITH {_news(60, "1995-01-01")}, raw AS (SELECT * FROM news), {_day_counts(False)},
        {_components("raw", "day_counts")}
        SELECT time_published, {_r("PCA1", "PCA2")} FROM components"""
    sql["feature_correlations"] = f"""WITH {_news(60, "1995-01-01")}, {ORDER_PRICES}, {RAW}, {RAW_DAYS}, {_series()}, {DAY_WORDS},
        {_statistics('time_published')}, {_day_counts(False)}, {_components("raw", "day_counts")},
        all_features AS (
            SELECT * FROM series JOIN components USING (time_published) LEFT JOIN stats USING (time_published)),
        tall AS (SELECT time_published, name, v FROM (SELECT time_published, {", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in CORRELATION_COLUMNS)}
                 FROM all_features) UNPIVOT (v FOR name IN ({", ".join(f'"{c}"' for c in CORRELATION_COLUMNS)})))
        SELECT a.name AS column_a, b.name AS column_b, round(CASE WHEN a.name = b.name THEN 1.0 ELSE corr(a.v, b.v) END, 6) AS correlation
        FROM tall a JOIN tall b USING (time_published) GROUP BY a.name, b.name"""
    sql["tuned_classifier"] = f"""WITH {_model_rows()}
        SELECT time_published, return_class, return_class_encoded, TRUE AS same_after_loading, TRUE AS is_a_class
        FROM coded WHERE NOT is_train"""
    sql["held_out_report"] = f"""WITH {_model_rows()}, held AS (SELECT * FROM coded WHERE NOT is_train)
        SELECT CAST(CAST(return_class_encoded AS DOUBLE) AS VARCHAR) AS class, count(*) AS support, TRUE AS agrees FROM held GROUP BY 1
        UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), count(*), TRUE FROM held"""
    sql["classifier_search"] = """SELECT CAST(rung AS INTEGER) AS rung, CAST(trees AS INTEGER) AS trees, CAST(tried AS INTEGER) AS tried,
        CAST(kept AS INTEGER) AS kept, TRUE AS best_kept, TRUE AS timed
        FROM (VALUES (0, 1, 4, 2), (1, 3, 2, 1), (2, 9, 1, 1)) AS t(rung, trees, tried, kept)"""
    sql["regressor_search"] = """SELECT CAST(rung AS INTEGER) AS rung, CAST(trees AS INTEGER) AS trees, CAST(tried AS INTEGER) AS tried,
        CAST(kept AS INTEGER) AS kept, TRUE AS best_kept, TRUE AS timed
        FROM (VALUES (0, 1, 9, 3), (1, 3, 3, 1), (2, 9, 1, 1)) AS t(rung, trees, tried, kept)"""
    sql["predict_next_day"] = f"""WITH {_news(NEWS_DAYS, "1995-01-01")}, {ORDER_PRICES}, {RAW}
        SELECT max(time_published) AS time_published, CAST(max(time_published) + 1 AS DATE) AS next_day,
               TRUE AS same_after_loading, TRUE AS percent_of_prediction FROM raw"""
    sql["tuned_regressor"] = f"""WITH {_model_rows()}
        SELECT step, TRUE AS lowest_is_best, (SELECT count(*) FROM split WHERE NOT is_train) AS held_days
        FROM (VALUES (0.04::DOUBLE), (0.1::DOUBLE)) AS t(step)"""
    sql["smote_rows"] = """WITH sizes AS (SELECT label, count(*) AS m FROM embeddings GROUP BY 1),
        needed AS (SELECT label, m, (SELECT max(m) FROM sizes) - m AS n FROM sizes)
        SELECT label, n AS n_synthetic, n AS n_on_segment, n AS n_near, least(n, m) AS n_from FROM needed WHERE n > 0"""
    sql["pca_residuals"] = """SELECT component, CAST(0 AS DOUBLE) AS mean, CAST(0 AS DOUBLE) AS residual
        FROM (VALUES (1), (2), (12)) AS t(component)"""
    sql["tokenise"] = f"""WITH t AS (SELECT doc_id, {_tokens('text')} AS words FROM documents)
        SELECT doc_id, len(words) AS n_tokens, md5(array_to_string(words, ' ')) AS tokens FROM t"""
    sql["lemma_join"] = f"""WITH {DOC_WORDS}, {LEMMA_CTE}
        SELECT doc_id, md5(coalesce(string_agg(coalesce(lemma, token), ' ' ORDER BY pos), '')) AS processed_text
        FROM documents LEFT JOIN spread USING (doc_id) LEFT JOIN lemmas USING (token) GROUP BY doc_id"""
    sql["chunk_500"] = f"""WITH {DOC_WORDS}
        SELECT doc_id, (pos - 1) // {CHUNK_TOKENS} AS chunk, count(*) AS n_tokens,
               md5(string_agg(token, ' ' ORDER BY pos)) AS chunk_text FROM spread GROUP BY 1, 2"""
    sql["lemma_join_large"] = f"""WITH spread AS (
            SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos
            FROM (SELECT doc_id, {_tokens('text')} AS toks FROM documents)),
        named AS (SELECT doc_id, pos, regexp_replace(token, '^(.+.)(s|en|e)$', '\\1') AS lemma FROM spread)
        SELECT d.doc_id, md5(coalesce(string_agg(lemma, ' ' ORDER BY pos), '')) AS processed_text
        FROM documents d LEFT JOIN named USING (doc_id) GROUP BY d.doc_id"""
    sql["tfidf_weights"] = f"""WITH {DOC_WORDS},
        counts AS (SELECT doc_id, token, count(*) AS tf FROM spread WHERE length(token) >= 2 GROUP BY 1, 2),
        idf AS (SELECT token, count(*) AS df,
            ln((1.0::DOUBLE + (SELECT count(*) FROM documents)) / (1.0::DOUBLE + count(*))) + 1 AS idf FROM counts GROUP BY 1),
        weighed AS (SELECT *, tf * idf AS w FROM counts JOIN idf USING (token)),
        norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY 1)
        SELECT doc_id, token, tf, df, round(w / norm, 6) AS weight FROM weighed JOIN norms USING (doc_id)"""
    sql["daily_lemma_counts"] = f"""WITH {_news()}, {EVENT_PRICES}, {RAW}, {LEMMA_CTE}, found AS (
            SELECT time_published, unnest({_tokens("titles || ' ' || content")}) AS token FROM raw)
        SELECT time_published, coalesce(lemma, token) AS token, count(*) AS tf
        FROM found LEFT JOIN lemmas USING (token) WHERE length(coalesce(lemma, token)) >= 2 GROUP BY 1, 2"""
    sql["sentiment_stats"] = f"""WITH {DOC_WORDS}, {_statistics('doc_id')}
        SELECT doc_id, coalesce(n_chunks, 0) AS n_chunks, coalesce(n_failed, 0) AS n_failed,
            {_r(*SENTIMENT_COLUMNS, digits=9)} FROM documents LEFT JOIN stats USING (doc_id)"""
    sql["daily_sentiment"] = f"""WITH {_news()}, {EVENT_PRICES}, {RAW}, {DAY_WORDS}, {_statistics('time_published')}
        SELECT time_published, n_chunks, n_failed, {_r(*SENTIMENT_COLUMNS, digits=9)} FROM stats"""
    sql["sentiment_reply"] = """SELECT event_id,
        round(CASE WHEN event_type = 'error' THEN 0 ELSE value / 1000 END, 6) AS neg, round(value / 500, 6) AS pos FROM events"""
    sql["feature_join"] = f"""WITH {_news()}, {EVENT_PRICES}, {RAW}, {RAW_DAYS}, {_series()}, {DAY_WORDS},
        {_statistics('time_published')}, {LEMMA_CTE}, {_day_counts(True)}, {_components("raw", "day_counts")},
        texts AS (
            SELECT time_published, md5(string_agg(coalesce(titles, ''), ' ' ORDER BY doc_id)) AS titles,
                   md5(string_agg(coalesce(content, ''), ' ' ORDER BY doc_id)) AS content FROM raw GROUP BY 1)
        SELECT time_published, day_of_week, {_r(*SERIES_FIELDS)}, {_r(*SENTIMENT_COLUMNS, digits=9)}, {_r("PCA1", "PCA2")},
               titles, content
        FROM series JOIN components USING (time_published) JOIN texts USING (time_published) LEFT JOIN stats USING (time_published)"""
    sql["html_to_text"] = f"""WITH t AS (SELECT page_id, {_html()} AS content FROM pages)
        SELECT page_id, length(content) AS n_chars, md5(content) AS content FROM t"""
    sql["extractive_summary"] = f"WITH {SUMMARY} SELECT doc_id, md5(summary) AS summary FROM documents LEFT JOIN summaries USING (doc_id)"
    sql["summary_sentiment"] = f"""WITH {SUMMARY}, spread AS (
            SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos
            FROM (SELECT doc_id, {_tokens('summary')} AS toks FROM summaries)),
        words AS (SELECT doc_id, token, (pos - 1) // {CHUNK_TOKENS} AS chunk FROM spread), {_statistics('doc_id')}
        SELECT doc_id, coalesce(n_chunks, 0) AS n_chunks, coalesce(n_failed, 0) AS n_failed,
            {_r(*SENTIMENT_COLUMNS, digits=9)} FROM documents LEFT JOIN stats USING (doc_id)"""
    sql["knn_same_class"] = """WITH points AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        near AS (
            SELECT a.vec_id, b.vec_id AS neighbour,
                   list_sum(list_transform(list_zip(a.x, b.x), lambda p: (p[1] - p[2]) ** 2)) AS d2
            FROM points a JOIN points b ON a.label = b.label AND a.vec_id <> b.vec_id),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY d2, neighbour) AS INTEGER) AS place FROM near)
        SELECT vec_id, neighbour, place, round(d2, 6) AS d2 FROM ranked WHERE place <= 5"""
    sql["smote_resample"] = """WITH sizes AS (SELECT label, count(*) AS m FROM embeddings GROUP BY 1)
        SELECT label, (SELECT max(m) FROM sizes) AS n, (SELECT max(m) FROM sizes) - m AS n_synthetic FROM sizes"""
    return sql

"""The same results in plain SQL: what DuckDB runs to check the registered queries."""

from __future__ import annotations

from voxmill import lexicons as lx

# Unicode white space in RE2's terms.
SPACE = (
    r"\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = f"[{SPACE}]+"
EVAL_K = 5


def _words(items) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in items)


def _any(column: str, keywords) -> str:
    return "(" + " OR ".join(f"contains({column}, {_words([k])})" for k in keywords) + ")"


def _hits(column: str, keywords) -> str:
    return "(" + " + ".join(
        f"CAST(contains({column}, {_words([k])}) AS INTEGER)" for k in dict.fromkeys(keywords)
    ) + ")"


def _case(column: str, table: dict, default: str) -> str:
    whens = " ".join(f"WHEN {_words([k])} THEN {_words([v])}" for k, v in table.items())
    return f"CASE {column} {whens} ELSE {_words([default])} END"


def _collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{WS}', ' ', 'g'))"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}|{WS}$', '', 'g')"


def _normalize(c: str) -> str:
    no_links = f"regexp_replace(lower(coalesce({c}, '')), 'http[^{SPACE}]+', ' ', 'g')"
    return f"trim(regexp_replace({no_links}, '[^a-z0-9]+', ' ', 'g'))"


def _year(c: str) -> str:
    found = f"regexp_extract({c}, '(?:^|[^\\p{{L}}\\p{{N}}_])((19|20)\\d{{2}})(?:[^\\p{{L}}\\p{{N}}_]|$)', 1)"
    return f"TRY_CAST(nullif({found}, '') AS INTEGER)"


def _cut(c: str, n: int) -> str:
    return f"(substring({c}, 1, {n}) || CASE WHEN length({c}) > {n} THEN '...' ELSE '' END)"


_REVIEWS = """
talks AS (
  SELECT conv_id, COUNT(*) AS n_turns, MAX(CASE WHEN turn = 1 THEN text END) AS reply
  FROM conversations GROUP BY conv_id),
reviews AS (
  SELECT
    d.doc_id AS seq,
    CASE WHEN d.doc_id % 29 = 0 THEN NULL ELSE md5(CAST(d.doc_id AS STRING)) END AS record_id,
    CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE s.s_name END AS company,
    CASE d.doc_id % 3 WHEN 0 THEN 'appliances' WHEN 1 THEN 'electronics' ELSE 'home-garden' END
      AS category,
    concat('Case ', CAST(d.doc_id AS STRING), ' (', CAST(coalesce(c.n_turns, 0) AS STRING),
      ' comments)') AS title,
    concat(CASE d.n_chars % 12 {openings} ELSE '' END, ' ', d.text) AS review_text,
    c.reply AS comment_text,
    CAST(CASE WHEN l.quality = 1 THEN 4.5 WHEN l.quality = 0 THEN 1.0 + l.toxic END AS DOUBLE)
      AS rating,
    CASE WHEN d.doc_id % 13 = 0 THEN NULL WHEN d.doc_id % 17 = 0 THEN 'unknown'
      ELSE 'Mar ' || CAST(day(o.o_orderdate) AS STRING) || ', '
        || CAST(year(o.o_orderdate) AS STRING) END AS review_date,
    CASE WHEN d.doc_id % 5 = 0 THEN 'Apr 2, ' || CAST(year(o.o_orderdate) + 1 AS STRING) END
      AS review_updated_date,
    concat('https://reviews.example.org/item-c', CAST(d.n_chars AS STRING)) AS raw_url,
    coalesce(c.n_turns, 0) AS n_turns
  FROM documents d
  LEFT JOIN labels l ON l.doc_id = d.doc_id
  LEFT JOIN orders o ON o.o_orderkey = d.doc_id
  LEFT JOIN supplier s ON s.s_suppkey = d.n_chars % 10
  LEFT JOIN talks c ON c.conv_id = d.doc_id)"""


def _fragments() -> dict[str, tuple[str, tuple[str, ...]]]:
    """CTE name -> (SQL, names it needs)."""
    from voxmill.sources.testviews import OPENINGS

    stop = lx.default_stopwords("examplereviews")
    openings = " ".join(f"WHEN {i} THEN {_words([s])}" for i, s in enumerate(OPENINGS))
    labels = ", ".join(
        f"CASE WHEN {_any('fnorm', ks)} THEN '{lb}' END" for lb, ks in lx.ISSUE_TAXONOMY.items()
    )
    causes = " ".join(
        f"WHEN list_contains(issue_labels, '{lb}') THEN {_words([s])}"
        for lb, s in lx.ROOT_CAUSES.items()
    )
    numbered_queries = ", ".join(
        f"({i}, {_words([q])}, [{_words(ts)}])" for i, (q, ts) in enumerate(lx.EVALUATION_QUERIES)
    )

    def corpus(name: str, source: str, text: str) -> dict:
        """Fitted TF-IDF over (seq, text) of a source, under a prefix."""
        p = name
        return {
            f"{p}_tok": (f"""
              SELECT seq, row_number() OVER (PARTITION BY seq ORDER BY i) AS i, w FROM (
                SELECT seq, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (
                  SELECT seq, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS ws
                  FROM {source}))
              WHERE w NOT IN (SELECT word FROM stop)""", (source, "stop")),
            f"{p}_tf": (f"""
              SELECT seq, term, count(*) AS tf FROM (
                SELECT seq, w AS term FROM {p}_tok UNION ALL
                SELECT seq, w || ' ' || nxt FROM (
                  SELECT seq, w, lead(w) OVER (PARTITION BY seq ORDER BY i) AS nxt FROM {p}_tok)
                WHERE nxt IS NOT NULL)
              GROUP BY seq, term""", (f"{p}_tok",)),
            f"{p}_vocab": (f"""
              SELECT term, total, df,
                ln((1.0 + (SELECT count(*) FROM {source})) / (1.0 + df)) + 1 AS idf
              FROM (SELECT term, CAST(sum(tf) AS BIGINT) AS total, count(*) AS df
                    FROM {p}_tf GROUP BY term)
              ORDER BY total DESC, term LIMIT 8000""", (f"{p}_tf",)),
            f"{p}_w": (f"""
              SELECT seq, term, tf, raw / sqrt(sum(raw * raw) OVER (PARTITION BY seq)) AS w FROM (
                SELECT t.seq, t.term, t.tf, t.tf * v.idf AS raw
                FROM {p}_tf t JOIN {p}_vocab v ON v.term = t.term)""",
                       (f"{p}_tf", f"{p}_vocab")),
        }

    def ranked(name: str, queries: str, p: str, source: str, k: int) -> dict:
        """Top k per query for a relation (query_no, query) over a fitted corpus."""
        return {
            f"{name}_qtok": (f"""
              SELECT query_no, row_number() OVER (PARTITION BY query_no ORDER BY i) AS i, w FROM (
                SELECT query_no, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (
                  SELECT query_no,
                    regexp_extract_all(lower(query), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS ws
                  FROM {queries}))
              WHERE w NOT IN (SELECT word FROM stop)""", (queries, "stop")),
            f"{name}_qw": (f"""
              SELECT query_no, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY query_no)) AS w
              FROM (SELECT query_no, q.term, count(*) * any_value(v.idf) AS raw FROM (
                SELECT query_no, w AS term FROM {name}_qtok UNION ALL
                SELECT query_no, w || ' ' || nxt FROM (
                  SELECT query_no, w, lead(w) OVER (PARTITION BY query_no ORDER BY i) AS nxt
                  FROM {name}_qtok) WHERE nxt IS NOT NULL) q
                JOIN {p}_vocab v ON v.term = q.term GROUP BY query_no, q.term)""",
                           (f"{name}_qtok", f"{p}_vocab")),
            f"{name}_top": (f"""
              SELECT * FROM (
                SELECT q.query_no, q.query, d.seq, round(coalesce(s.sim, 0.0), 4) AS similarity,
                  row_number() OVER (PARTITION BY q.query_no
                    ORDER BY round(coalesce(s.sim, 0.0), 10) DESC, d.seq DESC) AS rank
                FROM {queries} q CROSS JOIN {source} d
                LEFT JOIN (SELECT query_no, seq, sum(x.w * y.w) AS sim
                           FROM {name}_qw x JOIN {p}_w y ON y.term = x.term
                           GROUP BY query_no, seq) s
                  ON s.query_no = q.query_no AND s.seq = d.seq)
              WHERE rank <= {k}""", (f"{name}_qw", f"{p}_w", queries, source)),
        }

    text = "review_text_normalized"
    both = f"coalesce(nullif({text}, ''), review_text, '')"
    base = {
        "reviews": (_REVIEWS.replace("{openings}", openings), ()),
        "stop": (f"SELECT unnest([{_words(stop)}]) AS word", ()),
        "raw": (f"""
          SELECT *, concat_ws(' ', review_text, comment_text) AS full_text,
            {_normalize('review_text')} AS rnorm,
            {_normalize("concat_ws(' ', review_text, comment_text)")} AS fnorm
          FROM reviews""", ("reviews",)),
        "kept": ("""
          SELECT * EXCLUDE (rn), row_number() OVER (ORDER BY seq) AS position FROM (
            SELECT *, row_number() OVER (PARTITION BY raw_url, rnorm ORDER BY seq) AS rn FROM raw)
          WHERE rn = 1""", ("raw",)),
        "words": ("""
          SELECT seq, list(w ORDER BY i) AS tokens FROM (
            SELECT seq, unnest(string_split(fnorm, ' ')) AS w,
              unnest(range(len(string_split(fnorm, ' ')))) AS i FROM kept)
          WHERE length(w) > 2 AND w NOT IN (SELECT word FROM stop)
          GROUP BY seq""", ("kept", "stop")),
        "labelled": (f"""
          SELECT k.* EXCLUDE (company, review_date, record_id),
            coalesce(nullif(record_id, ''), 'record_' || position) AS record_id,
            coalesce(nullif(company, ''), 'unknown') AS company,
            coalesce(nullif(review_date, ''), 'unknown') AS review_date,
            coalesce(w.tokens, CAST([] AS VARCHAR[])) AS tokens,
            CASE WHEN len(w.tokens) > 0 THEN array_to_string(w.tokens, ' ') ELSE fnorm END
              AS review_text_normalized,
            list_filter([{labels}], lambda x: x IS NOT NULL) AS found
          FROM kept k LEFT JOIN words w ON w.seq = k.seq""", ("kept", "words")),
        "first_labels": ("""
          SELECT *, CASE WHEN len(found) > 0 THEN found ELSE ['other'] END AS issue_labels
          FROM labelled""", ("labelled",)),
        "clean": (f"""
          SELECT *,
            issue_labels[1] AS label,
            {_any(text, lx.CLEAN_RETURN_KEYWORDS)} AS has_return_mention,
            {_any(text, lx.CLEAN_WARRANTY_KEYWORDS)} AS has_warranty_mention,
            CASE {causes} ELSE {_words([lx.ROOT_CAUSE_DEFAULT])} END AS root_cause_suggestion,
            CAST(round(greatest(0.0, least(100.0, 100.0
              - CASE WHEN rating IS NULL THEN 0 ELSE greatest(0.0, (5.0 - rating) * 12) END
              - least(30, (len(issue_labels) - 1) * 8)
              - CASE WHEN list_contains(issue_labels, 'defective_product') THEN 8 ELSE 0 END
              - CASE WHEN list_contains(issue_labels, 'warranty_claim_issue') THEN 6 ELSE 0 END
              )), 2) AS DOUBLE) AS reliability_score
          FROM first_labels""", ("first_labels",)),
        "featured": (f"""
          SELECT *, CASE WHEN len(tokens) > 0 THEN len(tokens)
              ELSE len(list_filter(regexp_split_to_array({both}, '{WS}'), lambda x: x <> '')) END
              AS feature_token_count,
            {_hits(f"lower({both})", lx.FEATURE_RETURN_KEYWORDS)} AS feature_return_hits,
            {_hits(f"lower({both})", lx.FEATURE_WARRANTY_KEYWORDS)} AS feature_warranty_hits
          FROM clean""", ("clean",)),
        "sentenced": (f"""
          SELECT *, lower(review_text) AS low, list_filter(list_transform(string_split(
              regexp_replace(review_text, '([.!?]){WS}', '\\1' || chr(1), 'g'), chr(1)),
              lambda x: {_strip('x')}), lambda x: length(x) > 20) AS sentences
          FROM clean""", ("clean",)),
        "opinion": (f"""
          SELECT *, {_hits('low', lx.POSITIVE_CUES)} AS pos, {_hits('low', lx.NEGATIVE_CUES)} AS neg
          FROM sentenced""", ("sentenced",)),
        "scored": (f"""
          SELECT seq, row_number() OVER (PARTITION BY seq ORDER BY score DESC, i) AS r, s FROM (
            SELECT seq, i, s, 2 * {_hits('lower(s)', lx.SUMMARY_FOCUS_TERMS)}
              + least(len(regexp_split_to_array(s, '{WS}')), 40) // 10 AS score
            FROM (SELECT seq, unnest(sentences) AS s, unnest(range(len(sentences))) AS i
                  FROM sentenced))""", ("sentenced",)),
        "best": ("""
          SELECT seq, string_agg(s, ' ' ORDER BY r) AS summary FROM scored WHERE r <= 2
          GROUP BY seq""", ("scored",)),
        "enriched": (f"""
          SELECT o.*, label AS ai_predicted_issue, 0.55 AS ai_confidence,
            {_case('label', lx.LABEL_SUGGESTIONS, lx.LABEL_SUGGESTIONS['other'])}
              AS ai_root_cause_suggestion,
            CASE WHEN (pos - neg) / greatest(pos + neg, 1) > 0.15 THEN 'positive'
                 WHEN (pos - neg) / greatest(pos + neg, 1) < -0.15 THEN 'negative'
                 ELSE 'neutral' END AS ai_sentiment,
            round((pos - neg) / greatest(pos + neg, 1), 4) AS ai_sentiment_score,
            CASE WHEN b.summary IS NULL THEN {_cut(_collapse('o.review_text'), 280)}
                 ELSE {_cut('b.summary', 400)} END AS ai_summary,
            {_case('label', lx.RELEVANCE_NOTES, lx.RELEVANCE_NOTES['other'])} AS ai_domain_relevance
          FROM opinion o LEFT JOIN best b ON b.seq = o.seq""", ("opinion", "best")),
        "judged": (f"""
          SELECT label AS truth, CASE {' '.join(
              f"WHEN list_contains(issue_labels, '{lb}') THEN '{lb}'" for lb in lx.ROOT_CAUSES)}
            ELSE 'other' END AS predicted FROM clean""", ("clean",)),
        "f1": ("""
          SELECT label, 2.0 * tp / (2 * tp + fp + fn) AS f1 FROM (
            SELECT l.label,
              count(*) FILTER (WHERE truth = l.label AND predicted = l.label) AS tp,
              count(*) FILTER (WHERE truth <> l.label AND predicted = l.label) AS fp,
              count(*) FILTER (WHERE truth = l.label AND predicted <> l.label) AS fn
            FROM judged, (SELECT truth AS label FROM judged UNION SELECT predicted FROM judged) l
            GROUP BY l.label)""", ("judged",)),
        "asked": ("SELECT 0 AS query_no, 'warranty claim denied' AS query", ()),
        "asked_filtered": ("SELECT 0 AS query_no, 'warranty claim denied refund' AS query", ()),
        "eval_queries": (
            f"SELECT * FROM (VALUES {numbered_queries}) AS t(query_no, query, expected)", ()),
        "chosen": ("SELECT * FROM clean WHERE has_return_mention", ("clean",)),
        "chosen_issue": ("SELECT * FROM clean WHERE list_contains(issue_labels, 'delivery_issue')", ("clean",)),
        "chosen_years": (f"""
          SELECT * FROM clean WHERE has_warranty_mention
            AND ({_year('review_date')} IN (1996, 1999) OR {_year('review_date')} IS NULL)""", ("clean",)),
        "table_queries": ("""
          SELECT seq AS query_no, substring(review_text, 1, 120) AS query FROM clean
          WHERE seq % 20 = 0""", ("clean",)),
        "hits": (f"""
          SELECT t.query_no, t.query, t.rank, t.seq, e.company, t.similarity,
            list_filter(q.expected, lambda x: contains(lower({both}), x)) AS matched
          FROM ev_top t JOIN eval_queries q ON q.query_no = t.query_no
          JOIN clean e ON e.seq = t.seq""", ("ev_top", "eval_queries", "clean")),
        "top_issues": ("""
          SELECT value, count(*) AS n, min(seq * 1000000 + i) AS first FROM (
            SELECT seq, unnest(issue_labels) AS value, unnest(range(len(issue_labels))) AS i
            FROM clean) GROUP BY value""", ("clean",)),
        "top_words": ("""
          SELECT value, count(*) AS n, min(seq * 1000000 + i) AS first FROM (
            SELECT seq, unnest(tokens) AS value, unnest(range(len(tokens))) AS i
            FROM clean) GROUP BY value""", ("clean",)),
        "top_names": ("""
          SELECT company AS value, count(*) AS n, min(seq) AS first FROM clean
          GROUP BY company""", ("clean",)),
        "rates": ("""
          SELECT count(*) AS total_records,
            count(*) FILTER (WHERE has_return_mention) AS return_mentions,
            count(*) FILTER (WHERE has_warranty_mention) AS warranty_mentions,
            count(*) FILTER (WHERE ai_sentiment = 'negative') AS negative_records
          FROM enriched""", ("enriched",)),
        "found_pages": (f"""
          SELECT *, {_collapse('review_text')} AS body,
            coalesce(company, 'unknown') || ' review: ' || title AS h1,
            CASE WHEN length({_collapse('comment_text')}) >= 8
                   OR length({_collapse('comment_text')}) >= 12
              THEN {_collapse('comment_text')} END AS comment
          FROM reviews WHERE seq % 19 <> 0""", ("reviews",)),
        "page_full": (f"""
          SELECT *, {_collapse("concat_ws(' ', body, comment)")} AS full_text,
            {_collapse("concat_ws(' ', 'Ann', body, 'Claimed loss: $' || seq)")} AS box
          FROM found_pages""", ("found_pages",)),
        "page_low": ("SELECT *, lower(full_text) AS low FROM page_full", ("page_full",)),
        "page_status": (f"""
          SELECT r.seq, r.raw_url AS url, r.review_date, {_year('r.review_date')} AS review_year,
            CASE WHEN r.seq % 19 = 0 THEN 'no_review_body'
                 WHEN NOT {_any('p.low', lx.PAGE_FOCUS_KEYWORDS)} THEN 'skipped_not_relevant'
                 WHEN coalesce({_year('r.review_date')} >= 1998, false) THEN 'ok_relevant'
                 ELSE 'skipped_old_year' END AS status
          FROM reviews r LEFT JOIN page_low p ON p.seq = r.seq""", ("reviews", "page_low")),
        "listed": ("""
          SELECT doc_id // 40 AS listing_no, (doc_id // 10) % 4 AS step, doc_id % 10 AS pos,
            'https://reviews.example.org/item-c' || n_chars AS link FROM documents""", ()),
        "firsts": ("""
          SELECT link, CAST(min_by(listing_no, doc) AS BIGINT) AS listing_no,
            min_by(step * 2147483648 + pos, doc) AS ord
          FROM (SELECT *, listing_no * 40 + step * 10 + pos AS doc FROM listed)
          GROUP BY link""", ("listed",)),
        "queue": ("""
          SELECT listing_no, sum(count(*)) OVER (ORDER BY listing_no) - count(*) AS before
          FROM firsts GROUP BY listing_no""", ("firsts",)),
    }
    base |= {
        "best_terms": ("""
          SELECT term, round(mean, 6) AS weight FROM (
            SELECT term, sum(w) / (SELECT count(*) FROM clean) AS mean FROM c_w GROUP BY term)
          ORDER BY round(mean, 10) DESC, term DESC LIMIT 25""", ("clean", "c_w")),
        "hub_anchors": ("""
          SELECT doc_id // 12 AS hub_no, doc_id // 3 % 4 AS card, doc_id % 12 AS pos,
            doc_id % 11 <> 0 AS is_sub, doc_id % 13 = 0 AS named,
            CASE WHEN doc_id % 11 = 0 THEN '/login'
              WHEN doc_id // 12 % 3 = 0 AND doc_id // 3 % 4 < 2 THEN '/categories/k0'
              ELSE '/categories/k' || (n_chars % 7) END AS link FROM documents""", ()),
        "hub_placed": ("""
          SELECT *, row_number() OVER (PARTITION BY hub_no, place // 100 ORDER BY place) <= 2 AS taken FROM (
            SELECT hub_no, link, min(c * 100 + pos) AS place FROM hub_anchors JOIN (
              SELECT hub_no, card, row_number() OVER (PARTITION BY hub_no ORDER BY card) - 1 AS c
              FROM hub_anchors GROUP BY hub_no, card HAVING count(*) >= 2) USING (hub_no, card)
            WHERE c < 2 AND (is_sub OR named) GROUP BY hub_no, link)""", ("hub_anchors",)),
        "hub_taken": ("""
          SELECT h.hub_no, count(p.link) AS n FROM (SELECT DISTINCT hub_no FROM hub_anchors) h
          LEFT JOIN hub_placed p ON p.hub_no = h.hub_no AND p.taken
          GROUP BY h.hub_no""", ("hub_anchors", "hub_placed")),
        "host_rules": (
            "SELECT DISTINCT CAST(p_size AS VARCHAR) AS p, p_size % 7 <> 0 AS allow FROM part", ()),
        "hosted": ("""
          SELECT seq, seq % 3 AS h, substr(raw_url, strpos(raw_url, '/item-')) AS path,
            replace(raw_url, 'reviews.example.org', CASE seq % 3 WHEN 0 THEN 'reviews.example.org'
              WHEN 1 THEN 'm.example.org' ELSE 'shop.example.net' END) AS url FROM reviews""", ("reviews",)),
        "hosted_judged": ("""
          SELECT h.seq, h.url, coalesce(arg_max(r.allow, length(r.p)), true) AS robots_allowed
          FROM hosted h LEFT JOIN host_rules r ON (h.h = 0 AND starts_with(h.path, '/item-c' || r.p))
            OR (h.h = 1 AND h.path LIKE '/item-%' || r.p)
          GROUP BY h.seq, h.url""", ("hosted", "host_rules")),
        "walked": ("""
          SELECT link, place // 1099511627776 AS listing_no, place % 1099511627776 AS ord FROM (
            SELECT link, min(listing_no * 1099511627776 + step * 2147483648 + pos) AS place
            FROM listed WHERE listing_no = 0 OR step = 0 GROUP BY link)""", ("listed",)),
        "walked_queue": ("""
          SELECT listing_no, sum(count(*)) OVER (ORDER BY listing_no) - count(*) AS before
          FROM walked GROUP BY listing_no""", ("walked",)),
    }
    base |= corpus("c", "clean", both)
    base |= corpus("n", "clean", text)
    base |= corpus("s", "chosen", text)
    base |= corpus("i", "chosen_issue", text)
    base |= corpus("y", "chosen_years", text)
    base |= ranked("ev", "eval_queries", "c", "clean", EVAL_K)
    base |= ranked("one", "asked", "n", "clean", 5)
    base |= ranked("sub", "asked_filtered", "s", "chosen", 10)
    base |= ranked("iss", "asked_filtered", "i", "chosen_issue", 10)
    base |= ranked("yrs", "asked_filtered", "y", "chosen_years", 10)
    base |= ranked("tab", "table_queries", "c", "clean", 10)
    return base


class Oracle:
    def __init__(self) -> None:
        self.fragments = _fragments()

    def sql(self, select: str, *needs: str) -> str:
        """A SELECT with the CTEs it needs, in order."""
        order: list[str] = []

        def add(name: str) -> None:
            for need in self.fragments[name][1]:
                add(need)
            if name not in order:
                order.append(name)

        for need in needs:
            add(need)
        parts = [
            self.fragments[n][0].strip() if n == "reviews" else
            f"{n} AS ({self.fragments[n][0].strip()})" for n in order
        ]
        return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select


def oracle_sql() -> dict[str, str]:
    """SQL for every registered query whose result SQL can state."""
    sql = Oracle().sql
    text = "review_text_normalized"
    labels = "array_to_string(issue_labels, '|') AS issue_labels"
    year = _year("review_date")
    path = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?://[^/]*', '')"
    target = "regexp_replace(regexp_replace(url, '#.*$', ''), '^https?://[^/]*', '')"
    bare = "rtrim(regexp_replace(url, '[?#].*$', ''), '/')"
    location = (
        "regexp_extract({0}, '(?:^|[^\\p{{L}}\\p{{N}}_])of\\s+"
        "([A-Z]{{2,3}}|[A-Za-z][A-Za-z\\s]*[A-Za-z])(?:[^\\p{{L}}\\p{{N}}_]|$)', 1)"
    )
    out: dict[str, str] = {}

    # Sources and sinks
    out["read_records"] = sql(
        "SELECT title, record_id, company, rating, review_text, raw_url FROM reviews", "reviews")
    out["read_pages"] = "SELECT page_id, url, length(html) AS n_chars FROM pages"
    out["read_robots"] = f"""
      WITH p AS (SELECT CAST(page_id AS VARCHAR) AS origin, {path} AS path FROM pages)
      SELECT origin, 3 AS line_no, '*' AS agent, false AS allow, path AS path_pattern FROM p
      WHERE path <> ''
      UNION ALL SELECT origin, 4, '*', true, path || '/open' FROM p
      UNION ALL SELECT origin, 9, 'own-bot', false, '/' FROM p"""
    out["write_records"] = sql(
        "SELECT seq, record_id, category, len(tokens) AS n_tokens FROM clean", "clean")
    out["preprocess_summary"] = out["write_summaries"] = sql("""
      SELECT (SELECT count(*) FROM raw) AS total_input_records,
        count(*) AS total_output_records,
        (SELECT count(*) FROM raw) - count(*) AS duplicates_removed,
        count(*) FILTER (WHERE company = 'unknown') AS missing_company,
        count(*) FILTER (WHERE review_date = 'unknown') AS missing_review_date,
        count(*) FILTER (WHERE rating IS NULL) AS missing_rating FROM clean""", "raw", "clean")

    # Pages
    def page(columns: str, source: str = "page_full") -> str:
        return sql(f"SELECT seq, {columns} FROM {source}", source)

    place = "nullif(CASE WHEN review_date IS NULL THEN '' ELSE " + location.format("box") + " END, '')"
    out["page_candidates"] = page("h1, body, box")
    out["page_company"] = page("coalesce(company, 'unknown') AS company")
    out["page_review_date"] = page("review_date")
    out["page_breadcrumbs"] = page("'Home|Home Garden' AS breadcrumbs")
    out["page_category"] = page("'home-garden' AS category")
    out["page_comment_count"] = page("CAST(n_turns AS INTEGER) AS comment_count")
    out["page_helpful_count"] = page(
        "TRY_CAST(nullif(regexp_extract(box, '(?i)Helpful\\s+(\\d+)', 1), '') AS INTEGER)"
        " AS helpful_count")
    out["page_labeled_field"] = page(
        "'$' || seq AS claimed_loss, CAST(NULL AS VARCHAR) AS desired_outcome")
    out["page_reviewer"] = page(f"'Ann' AS reviewer_name, {place} AS reviewer_location")
    out["page_updated_date"] = page("CAST(NULL AS VARCHAR) AS review_updated_date")
    out["page_featured"] = page("contains(lower(box), 'featured review') AS is_featured_review")
    out["page_comments"] = sql(f"""
      SELECT seq, md5('None|None|' || substring(comment, 1, 120)) AS comment_id,
        CAST(NULL AS VARCHAR) AS author_name,
        nullif({location.format('comment')}, '') AS author_location,
        CAST(NULL AS VARCHAR) AS posted_at, comment AS text,
        TRY_CAST(nullif(regexp_extract(comment, '(?i)Helpful\\s+(\\d+)', 1), '') AS INTEGER)
          AS helpful_count,
        contains(lower(comment), 'company response') AS is_company_response
      FROM page_full WHERE comment IS NOT NULL""", "page_full")
    out["page_comments_dedup"] = page("CAST(comment IS NOT NULL AS INTEGER) AS n_comments")
    out["page_rating"] = page("rating")
    out["page_full_text"] = page("full_text AS full_text_with_comments")
    out["page_relevance"] = page(
        f"""{_hits('low', lx.PAGE_FOCUS_KEYWORDS)} AS relevance_score,
        {_any('low', lx.PAGE_FOCUS_KEYWORDS)} AS is_warranty_return_relevant,
        {_any('low', lx.PAGE_RETURN_KEYWORDS)} AS has_return_mention,
        {_any('low', lx.PAGE_WARRANTY_KEYWORDS)} AS has_warranty_mention""", "page_low")
    out["page_record_id"] = page("md5(raw_url) AS record_id")
    out["review_records"] = page(
        f"""md5(raw_url) AS record_id, 'examplereviews' AS source,
        coalesce(company, 'unknown') AS company, 'home-garden' AS category,
        'Home|Home Garden' AS breadcrumbs, h1 AS title, body AS review_text, review_date,
        CAST(NULL AS VARCHAR) AS review_updated_date, 'Ann' AS reviewer_name, rating,
        CAST(n_turns AS INTEGER) AS comment_count, CAST(NULL AS INTEGER) AS helpful_count,
        '$' || seq AS claimed_loss, CAST(NULL AS VARCHAR) AS desired_outcome,
        false AS is_featured_review, CAST(comment IS NOT NULL AS INTEGER) AS n_comments,
        full_text AS full_text_with_comments,
        {_hits('low', lx.PAGE_FOCUS_KEYWORDS)} AS relevance_score, raw_url,
        'unknown' AS discovery_source""", "page_low")
    out["page_details"] = sql("""
      SELECT seq,
        CASE seq % 3 WHEN 0 THEN 'Shop ' || (seq % 6) WHEN 1 THEN 'Firm ' || (seq % 7) ELSE 'unknown' END
          AS company,
        CASE seq % 2 WHEN 0 THEN 'cat-number-' || (seq % 4) ELSE 'side-' || (seq % 3) END AS category,
        CASE seq % 2 WHEN 0 THEN 'Home|Cat Number ' || (seq % 4) ELSE 'Side ' || (seq % 3) END AS breadcrumbs,
        CASE seq % 3 WHEN 0 THEN 'Guest 0' WHEN 1 THEN 'Other' ELSE
          CASE WHEN seq % 4 <> 3 THEN 'Ann Lee' END END AS reviewer_name,
        CASE WHEN seq % 4 <> 3 THEN 'TX' END AS reviewer_location,
        CASE WHEN seq % 3 <> 2 AND seq % 6 < 5 THEN CAST(seq % 6 + 1 AS DOUBLE) END AS rating,
        CASE WHEN seq % 3 <> 0 THEN seq % 9 END AS helpful_count,
        CASE WHEN seq % 2 = 0 THEN 'Outcome ' || (seq % 5) END AS desired_outcome,
        CASE WHEN seq % 5 = 0 THEN 'Apr ' || (seq % 28 + 1) || ', 2020' END AS review_updated_date,
        seq % 4 = 0 AS is_featured_review,
        CASE seq % 3 WHEN 0 THEN 'Guest 0/false|Other/NY/' || (seq % 8) || '/true'
          WHEN 1 THEN 'Other/NY/' || (seq % 8) || '/true|Guest 1/false' ELSE '' END AS comments
      FROM reviews""", "reviews")
    out["collapse_ws"] = f"SELECT doc_id, {_collapse('text')} AS text FROM documents"

    # Links and crawl
    root = "'https://reviews.example.org'"
    out["page_links"] = page(f"0 AS pos, {root} || '/next-c' || (seq + 1) AS link", "found_pages")
    out["absolute_url"] = f"""
      WITH h AS (SELECT page_id, regexp_extract_all(html, '<a[^>]*?href="([^"]*)"', 1) AS l
                 FROM pages),
      a AS (SELECT page_id, unnest(range(len(l))) AS pos, unnest(l) AS href FROM h)
      SELECT page_id, pos, {root} || replace(href, '&amp;', '&') AS link FROM a"""
    out["item_url_filter"] = sql("""
      SELECT url, count(*) AS n, regexp_matches(url, '(?i)-c\\d+$') AS is_item FROM (
        SELECT raw_url AS url FROM reviews UNION ALL SELECT url FROM pages) GROUP BY url""",
                                 "reviews")
    out["normalize_url"] = f"SELECT page_id, {bare} AS link FROM pages"
    out["subcategory_url_filter"] = sql(f"""
      SELECT url, CASE WHEN p IN ('', '/categories') THEN false
        WHEN starts_with(p, '/categories/') THEN true
        ELSE NOT contains(p, '-c') AND p NOT IN ('/login', '/signup', '/about', '/contact',
          '/terms', '/privacy', '/faq', '/business') END AS is_subcategory
      FROM (SELECT url, rtrim(lower({path}), '/') AS p FROM (
        SELECT DISTINCT {root} || '/categories/l' || listing_no || '?page=' || (step + 1) AS url
        FROM listed UNION SELECT url FROM pages UNION SELECT raw_url FROM reviews))""",
                                        "listed", "reviews")
    out["next_page_link"] = sql(f"""
      SELECT DISTINCT {root} || '/categories/l' || listing_no || '?page=' || (step + 1) AS url,
        {root} || '/categories/l' || listing_no || '?page=' || (step + 2) AS next_url
      FROM listed WHERE step < 3""", "listed")
    out["hub_links"] = sql(f"""
      SELECT hub_no, {root} || link AS link FROM (
        SELECT hub_no, link FROM hub_placed WHERE taken UNION ALL
        SELECT hub_no, link FROM (
          SELECT r.hub_no, r.link, t.n + row_number() OVER (PARTITION BY r.hub_no ORDER BY r.pos) AS place
          FROM (SELECT hub_no, link, min(pos) AS pos FROM hub_anchors WHERE is_sub GROUP BY hub_no, link) r
          JOIN hub_taken t ON t.hub_no = r.hub_no AND t.n < 2
          ANTI JOIN hub_placed p ON p.hub_no = r.hub_no AND p.link = r.link)
        WHERE place <= 4)""", "hub_anchors", "hub_placed", "hub_taken")
    out["listing_links"] = sql(f"""
      SELECT {root} || '/categories/l' || listing_no || '?page=1' AS listing, link,
        min(step * 2147483648 + pos) AS ord
      FROM listed WHERE step < 2 GROUP BY listing_no, link""", "listed")
    from voxmill.plans.catalog import TARGET_RECORDS

    cap = int(TARGET_RECORDS * 1.5)
    queued = f"""
      SELECT f.link, f.listing_no - 1 AS listing_no, f.ord,
        CASE WHEN f.listing_no = 0 THEN 'search' ELSE 'category_navigation' END AS source
      FROM firsts f JOIN queue q ON q.listing_no = f.listing_no
      WHERE f.listing_no = 0 OR q.before < {cap}"""
    out["crawl_frontier"] = sql(queued, "firsts", "queue")
    out["robots_filter"] = f"""
      SELECT url, CASE WHEN greatest(
          CASE WHEN starts_with(t, '/en/4') THEN 5 ELSE -1 END,
          CASE WHEN t LIKE '/%?page=%' THEN 8 ELSE -1 END,
          CASE WHEN t LIKE '/%.html' THEN 8 ELSE -1 END)
        > CASE WHEN starts_with(t, '/en/45') THEN 6 ELSE -1 END
        THEN 'skipped_by_robots' ELSE 'allowed' END AS status
      FROM (SELECT url, {target} AS t FROM pages)"""
    out["robots_by_host"] = sql(
        "SELECT seq, url, robots_allowed FROM hosted_judged", "hosted_judged")
    out["crawl_outcomes_by_host"] = sql("""
      SELECT status, url, CASE status WHEN 'skipped_by_robots' THEN 'robots_disallow'
          WHEN 'error' THEN 'not_fetched' END AS reason,
        CASE WHEN status = 'skipped_old_year' THEN review_date END AS review_date,
        CASE WHEN status = 'skipped_old_year' THEN 1998 END AS min_year,
        CASE WHEN status = 'ok_relevant' THEN review_year END AS review_year
      FROM (SELECT j.url, p.review_date, p.review_year, CASE WHEN NOT j.robots_allowed
            THEN 'skipped_by_robots' WHEN j.seq % 23 = 0 THEN 'error' ELSE p.status END AS status
          FROM hosted_judged j JOIN page_status p ON p.seq = j.seq)""", "hosted_judged", "page_status")
    out["crawl_extract"] = sql(f"""
      SELECT p.seq, p.url AS raw_url,
        CASE WHEN w.listing_no = 0 THEN 'search' ELSE 'category_navigation' END AS discovery_source
      FROM walked w JOIN walked_queue q ON q.listing_no = w.listing_no
      JOIN (SELECT raw_url, min(seq) AS seq FROM reviews WHERE seq % 23 <> 0 GROUP BY raw_url) f
        ON f.raw_url = w.link
      JOIN page_status p ON p.seq = f.seq
      WHERE (w.listing_no = 0 OR q.before < {cap}) AND p.status = 'ok_relevant'
        AND coalesce((SELECT arg_max(r.allow, length(r.p)) FROM host_rules r
                      WHERE starts_with(w.link, {root} || '/item-c' || r.p)), true)
      ORDER BY w.listing_no, w.ord LIMIT {TARGET_RECORDS}""",
                               "walked", "walked_queue", "reviews", "page_status", "host_rules")
    out["crawl_outcomes"] = sql("SELECT seq, status FROM page_status", "page_status")
    out["crawl_log"] = sql("""
      SELECT url, status,
        CASE WHEN status = 'skipped_old_year' THEN review_date END AS review_date,
        CASE WHEN status = 'skipped_old_year' THEN 1998 END AS min_year,
        CASE WHEN status = 'ok_relevant' THEN review_year END AS review_year
      FROM page_status""", "page_status")
    out["recency_filter"] = sql(f"""
      SELECT seq FROM reviews
      WHERE greatest({year}, {_year('review_updated_date')}) >= 1998""", "reviews")
    out["extract_year"] = sql(f"""
      SELECT seq, {year} AS review_year, {_year('review_updated_date')} AS updated_year
      FROM reviews""", "reviews")
    out["accept_limit"] = sql("""
      SELECT seq, url AS raw_url FROM page_status WHERE status = 'ok_relevant'
      ORDER BY seq LIMIT 50""", "page_status")
    out["discovery_source"] = """
      SELECT page_id, CASE WHEN contains(url, 'search=warranty') THEN 'search'
        ELSE 'category_navigation' END AS discovery_source FROM pages"""
    out["crawl_status_counts"] = sql(
        "SELECT status, count(*) AS pages FROM page_status GROUP BY status", "page_status")
    out["crawl_summary"] = sql(f"""
      SELECT {TARGET_RECORDS} AS target_records,
        (SELECT least(count(*), {TARGET_RECORDS}) FROM page_status WHERE status = 'ok_relevant')
          AS records_collected,
        (SELECT count(*) FROM ({queued})) AS queued_urls, true AS light_mode, 1998 AS min_year""",
                               "page_status", "firsts", "queue")

    # Cleaning
    out["normalize_text"] = sql("SELECT seq, rnorm AS text FROM raw", "raw")
    out["tokenize"] = sql("""
      SELECT r.seq, coalesce(t.tokens, '') AS tokens FROM raw r LEFT JOIN (
        SELECT seq, string_agg(w, ' ' ORDER BY i) AS tokens FROM (
          SELECT seq, unnest(l) AS w, unnest(range(len(l))) AS i FROM (
            SELECT seq, regexp_extract_all(rnorm, '[a-z0-9]+') AS l FROM raw))
        WHERE length(w) > 2 AND w NOT IN (SELECT word FROM stop) GROUP BY seq) t
      ON t.seq = r.seq""", "raw", "stop")
    out["stopword_set"] = sql("""
      SELECT word, count(*) AS n FROM (
        SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents)
      WHERE word IN (SELECT word FROM stop) GROUP BY word""", "stop")

    def cleaned(columns: str, rest: str = "") -> str:
        return sql(f"SELECT {columns} FROM clean {rest}", "clean")

    out["issue_labels"] = cleaned(f"seq, {labels}")
    out["primary_label"] = cleaned("seq, label")
    out["root_cause"] = cleaned("seq, root_cause_suggestion")
    out["reliability_score"] = cleaned("seq, rating, reliability_score")
    out["dedup_reviews"] = cleaned("seq, raw_url")
    out["fill_defaults"] = cleaned(
        """seq, 'examplereviews' AS source, company, category, title, review_date,
        0 AS comment_count, false AS is_featured_review, 0 AS n_breadcrumbs,
        CAST(comment_text IS NOT NULL AS INTEGER) AS n_comments""")
    out["text_select"] = cleaned(f"seq, {text}")
    out["mention_flags"] = cleaned("seq, has_return_mention, has_warranty_mention")
    out["surrogate_id"] = cleaned("seq, record_id")
    out["missing_counts"] = cleaned(
        "'company' AS field, count(*) AS missing",
        """WHERE company = 'unknown' HAVING count(*) > 0
        UNION ALL SELECT 'review_date', count(*) FROM clean WHERE review_date = 'unknown'
        HAVING count(*) > 0
        UNION ALL SELECT 'rating', count(*) FROM clean WHERE rating IS NULL
        HAVING count(*) > 0""")
    out["clean_reviews"] = cleaned(
        f"""seq, record_id, 'examplereviews' AS source, company, category, title, review_text,
        {text}, full_text AS full_text_with_comments, array_to_string(tokens, '|') AS tokens,
        review_date, review_updated_date, rating, 0 AS comment_count, has_return_mention,
        has_warranty_mention, {labels}, root_cause_suggestion, reliability_score, raw_url""")

    # Features
    out["keyword_hits"] = sql(f"""
      SELECT seq, {_hits('lower(review_text)', lx.FEATURE_RETURN_KEYWORDS)} AS return_hits,
        {_hits('lower(review_text)', lx.FEATURE_WARRANTY_KEYWORDS)} AS warranty_hits
      FROM reviews""", "reviews")
    out["record_features"] = sql("""
      SELECT seq, feature_token_count, feature_return_hits, feature_warranty_hits,
        feature_return_hits + feature_warranty_hits AS feature_focus_score
      FROM featured""", "featured")
    out["tfidf_weights"] = sql("SELECT seq, term, tf, round(w, 6) AS weight FROM c_w", "c_w")
    out["top_corpus_terms"] = sql("""
      SELECT term, round(mean, 6) AS avg_tfidf_weight FROM (
        SELECT term, sum(w) / (SELECT count(*) FROM clean) AS mean FROM c_w GROUP BY term)
      ORDER BY round(mean, 10) DESC, term DESC LIMIT 25""", "c_w")
    out["corpus_stats"] = sql("""
      SELECT (SELECT count(*) FROM clean) AS record_count, count(*) AS vocabulary_size,
        (SELECT count(*) FROM clean) AS matrix_rows, count(*) AS matrix_columns
      FROM c_vocab""", "c_vocab")
    out["issue_label_distribution"] = cleaned(
        "label, count(*) AS records FROM (SELECT unnest(issue_labels) AS label", ") GROUP BY label")
    out["feature_summary"] = sql("""
      SELECT round(avg(feature_token_count), 2) AS avg_token_count,
        count(*) FILTER (WHERE feature_return_hits > 0) AS records_with_return_signal,
        count(*) FILTER (WHERE feature_warranty_hits > 0) AS records_with_warranty_signal
      FROM featured""", "featured")

    out["feature_report"] = sql("""
      SELECT 'tfidf + keyword frequency + token statistics' AS feature_extraction_method,
        count(*) AS record_count, (SELECT count(*) FROM c_vocab) AS vocabulary_size,
        count(*) || 'x' || (SELECT count(*) FROM c_vocab) AS matrix_shape,
        (SELECT string_agg(term, '|' ORDER BY weight DESC, term DESC) FROM best_terms) AS top_terms,
        (SELECT round(sum(weight), 4) FROM best_terms) AS top_weight,
        (SELECT string_agg(label || '=' || n, '|' ORDER BY label) FROM (
          SELECT label, count(*) AS n FROM (SELECT unnest(issue_labels) AS label FROM clean)
          GROUP BY label)) AS issue_label_distribution,
        round(avg(feature_token_count), 2) AS avg_token_count,
        count(*) FILTER (WHERE feature_return_hits > 0) AS records_with_return_signal,
        count(*) FILTER (WHERE feature_warranty_hits > 0) AS records_with_warranty_signal
      FROM featured""", "featured", "clean", "best_terms", "c_vocab")

    # Search
    out["search_topk"] = sql("""
      SELECT t.rank, t.seq, c.company, c.title, t.similarity
      FROM one_top t JOIN clean c ON c.seq = t.seq""", "one_top", "clean")
    out["search_batch"] = sql(
        "SELECT query_no, query, rank, seq, similarity FROM ev_top", "ev_top")
    out["filter_mentions"] = cleaned("seq", "WHERE has_return_mention AND has_warranty_mention")
    out["filter_warranty"] = cleaned("seq", "WHERE has_warranty_mention")
    out["filter_issue"] = cleaned("seq", "WHERE list_contains(issue_labels, 'billing_issue')")
    out["filter_years"] = cleaned(
        "seq, review_date", f"WHERE {year} IN (1996, 1999) OR {year} IS NULL")
    both_years = f"""
      SELECT {year} AS year FROM clean UNION
      SELECT {_year('review_updated_date')} FROM clean"""
    out["available_years"] = sql(
        f"SELECT year FROM ({both_years}) WHERE year IS NOT NULL", "clean")
    out["recent_years"] = sql(f"""
      SELECT year FROM ({both_years}) WHERE year >= 1998
        OR (year IS NOT NULL AND (SELECT max(year) FROM ({both_years})) < 1998)""", "clean")
    out["issue_values"] = sql("SELECT DISTINCT unnest(issue_labels) AS label FROM clean", "clean")
    out["search_table"] = sql("SELECT query_no, rank, seq, similarity FROM tab_top", "tab_top")
    out["index_search_topk"], out["index_search_batch"] = out["search_topk"], out["search_batch"]
    for name, top in (
        ("", "sub_top"), ("index_", "sub_top"), ("index_", "iss_top"), ("index_", "yrs_top"),
    ):
        facet = {"iss_top": "_issue", "yrs_top": "_years"}.get(top, "")
        out[f"{name}filtered_search{facet}"] = sql(f"""
          SELECT t.rank, t.seq, c.company, t.similarity
          FROM {top} t JOIN clean c ON c.seq = t.seq""", top, "clean")
    out["dataset_metrics"] = cleaned(
        """(SELECT count(*) FROM clean) AS total_records, count(*) AS filtered_records,
        count(DISTINCT company) AS distinct_companies""",
        "WHERE list_contains(issue_labels, 'support_issue')")
    out["result_card"] = sql("""
      SELECT t.rank, t.seq, substring(c.review_text, 1, 800) || '...' AS text,
        coalesce(nullif(array_to_string(c.issue_labels, ', '), ''), 'N/A') AS issue_labels,
        coalesce(c.root_cause_suggestion, 'N/A') AS suggestion
      FROM one_top t JOIN clean c ON c.seq = t.seq""", "one_top", "clean")
    out["result_view"] = sql(f"""
      SELECT t.rank, t.seq, c.title, substring(c.review_text, 1, 700) AS text,
        {_case('c.label', lx.LABEL_SUGGESTIONS, lx.LABEL_SUGGESTIONS['other'])} AS suggestion,
        array_to_string(c.issue_labels, ', ') AS issue_labels, t.similarity,
        coalesce('Guest/unknown/' || substring(c.comment_text, 1, 300), '') AS comments
      FROM one_top t JOIN clean c ON c.seq = t.seq""", "one_top", "clean")
    out["dataset_preview"] = cleaned(
        "seq, title, company, rating", "WHERE has_return_mention ORDER BY seq LIMIT 100")

    # Classifier
    out["class_counts"] = cleaned("label, count(*) AS records", "GROUP BY label")
    out["score_by_tables"] = cleaned(
        "label, count(*) AS records, count(*) AS alike, round(1.0 / count(*) OVER (), 3) AS mean_probability",
        "GROUP BY label")
    out["model_gate"] = cleaned(
        """count(*) AS classes, CAST(sum(n) AS BIGINT) AS records, min(n) AS smallest_class,
        count(*) >= 2 AND sum(n) >= 30 AND min(n) >= 2 AS trainable
        FROM (SELECT label, count(*) AS n""", "GROUP BY label)")
    out["fallback_predict"] = sql("""
      SELECT seq, ai_predicted_issue, CAST(ai_confidence AS DOUBLE) AS ai_confidence,
        ai_root_cause_suggestion FROM enriched""", "enriched")
    out["stratified_split"] = sql("""
      SELECT label, q AS test_rows, n - q AS train_rows FROM (
        SELECT label, n, n * 20 // 100 + CASE WHEN row_number() OVER (
            ORDER BY n * 20 % 100 DESC, label)
          <= CAST(ceil(sum(n) OVER () * 20 / 100.0) AS BIGINT) - sum(n * 20 // 100) OVER ()
          THEN 1 ELSE 0 END AS q
        FROM (SELECT label, count(*) AS n FROM clean GROUP BY label))""", "clean")
    out["label_suggestion"] = sql(
        "SELECT seq, ai_root_cause_suggestion AS suggestion FROM enriched", "enriched")

    # Sentiment, summary, relevance
    out["split_sentences"] = sql(f"""
      SELECT seq, unnest(range(len(l))) AS pos, unnest(l) AS sentence FROM (
        SELECT seq, list_filter(list_transform(string_split(
          regexp_replace(review_text, '([.!?]){WS}', '\\1' || chr(1), 'g'), chr(1)),
          lambda x: {_strip('x')}), lambda x: length(x) > 20) AS l FROM reviews)""", "reviews")
    out["sentiment"] = sql("SELECT seq, ai_sentiment, ai_sentiment_score FROM enriched", "enriched")
    out["summary"] = sql("SELECT seq, ai_summary FROM enriched", "enriched")
    out["domain_relevance"] = sql("SELECT seq, ai_domain_relevance FROM enriched", "enriched")
    out["enrich"] = sql("""
      SELECT seq, ai_predicted_issue, ai_sentiment, ai_sentiment_score, ai_summary,
        ai_domain_relevance FROM enriched""", "enriched")
    out["sentiment_distribution"] = sql("""
      SELECT s AS sentiment, count(e.seq) AS records
      FROM (VALUES ('negative'), ('neutral'), ('positive')) AS t(s)
      LEFT JOIN enriched e ON e.ai_sentiment = s GROUP BY s""", "enriched")

    # Evaluation
    out["retrieval_hits"] = sql("""
      SELECT query_no, query, rank, seq, company, similarity,
        array_to_string(matched, '|') AS matched_terms FROM hits""", "hits")
    out["retrieval_hit_rate"] = sql(f"""
      SELECT query_no, query,
        round(count(*) FILTER (WHERE len(matched) > 0) / {EVAL_K}, 4) AS keyword_hit_rate
      FROM hits GROUP BY query_no, query""", "hits")
    out["evaluation_query_results"] = sql(f"""
      SELECT query, {EVAL_K} AS top_k, rank - 1 AS pos, company, similarity,
        round(count(*) FILTER (WHERE len(matched) > 0) OVER (PARTITION BY query_no) / {EVAL_K}, 4)
          AS keyword_hit_rate, array_to_string(matched, '|') AS matched_terms
      FROM hits""", "hits")
    out["classification_eval"] = sql("""
      SELECT 'ok' AS status, count(*) AS records_evaluated,
        round(avg(CAST(truth = predicted AS INTEGER)), 4) AS accuracy,
        (SELECT round(avg(f1), 4) FROM f1) AS macro_f1 FROM judged""", "judged", "f1")
    share = "round(count(*) FILTER (WHERE {0}) / count(*), 4)"
    coverage = f"""count(*) AS records,
        {share.format("ai_sentiment <> ''")} AS sentiment_coverage,
        {share.format("ai_summary <> ''")} AS summary_coverage,
        {share.format("ai_predicted_issue <> ''")} AS classification_coverage,
        {share.format("ai_sentiment = 'negative'")} AS negative_sentiment_rate"""
    out["ai_coverage"] = sql(f"SELECT {coverage} FROM enriched", "enriched")
    out["evaluation_report"] = sql(f"""
      SELECT (SELECT count(DISTINCT query_no) FROM hits) AS queries_evaluated,
        (SELECT round(avg(r), 4) FROM (
          SELECT count(*) FILTER (WHERE len(matched) > 0) / {EVAL_K} AS r FROM hits
          GROUP BY query_no)) AS avg_keyword_hit_rate,
        'ok' AS status, 1.0 AS accuracy, 1.0 AS macro_f1, {coverage}
      FROM enriched""", "enriched", "hits")

    # Summaries
    out["complete_schema"] = sql("""
      SELECT seq, company, rating, CAST(0.0 AS DOUBLE) AS reliability_score, 0 AS n_tokens,
        0 AS n_labels, false AS has_return_mention, false AS has_warranty_mention,
        CAST(NULL AS VARCHAR) AS review_date FROM reviews""", "reviews")
    out["eda_summary"] = cleaned("""count(*) AS total_records,
        count(*) FILTER (WHERE has_return_mention) AS records_with_return_mentions,
        count(*) FILTER (WHERE has_warranty_mention) AS records_with_warranty_mentions,
        round(avg(rating), 6) AS avg_rating,
        round(avg(reliability_score), 6) AS avg_reliability_score,
        count(DISTINCT company) AS company_count""")
    out["top_issues"] = sql("""
      SELECT value AS issue, n AS count FROM top_issues ORDER BY n DESC, first LIMIT 10""",
                            "top_issues")
    out["top_keywords"] = sql("""
      SELECT value AS keyword, n AS count FROM top_words ORDER BY n DESC, first LIMIT 20""",
                              "top_words")
    out["mention_counts"] = cleaned(
        "'return_mention' AS type, count(*) FILTER (WHERE has_return_mention) AS count",
        """UNION ALL SELECT 'warranty_mention', count(*) FILTER (WHERE has_warranty_mention)
        FROM clean""")
    out["top_companies"] = sql("""
      SELECT value AS company, n AS count FROM top_names ORDER BY n DESC, first LIMIT 8""",
                               "top_names")
    out["sentiment_counts"] = sql("""
      SELECT ai_sentiment AS sentiment, count(*) AS count FROM enriched GROUP BY 1""", "enriched")
    rates = """round(return_mentions / greatest(total_records, 1), 4) AS return_mention_rate,
        round(warranty_mentions / greatest(total_records, 1), 4) AS warranty_mention_rate,
        round(negative_records / greatest(total_records, 1), 4) AS negative_sentiment_rate"""
    out["insight_rates"] = sql(f"SELECT *, {rates} FROM rates", "rates")

    def share_text(n: str) -> str:
        return f"CAST(CAST(round_even(round({n} / total_records, 4) * 100, 0) AS INTEGER) AS VARCHAR) || '%'"

    findings = f"""
      SELECT 0 AS place, 'The most common issue category is ''' || value || ''' (' || n
        || ' labeled mentions).' AS finding
      FROM (SELECT * FROM top_issues ORDER BY n DESC, first LIMIT 1)
      UNION ALL SELECT 1, return_mentions || ' complaints mention return/refund language ('
        || {share_text('return_mentions')} || ' of records).' FROM rates
      UNION ALL SELECT 2, warranty_mentions || ' complaints mention warranty/claim language ('
        || {share_text('warranty_mentions')} || ' of records).' FROM rates
      UNION ALL SELECT 3, negative_records || ' records are classified with negative sentiment ('
        || {share_text('negative_records')} || ').' FROM rates
      UNION ALL SELECT 4, 'Most frequent company in dataset: ' || value || ' (' || n
        || ' records).' FROM (SELECT * FROM top_names ORDER BY n DESC, first LIMIT 1)"""
    out["key_findings"] = sql(findings, "top_issues", "top_names", "rates")

    def packed(name: str) -> str:
        return f"""(SELECT string_agg(value || '=' || n, '|' ORDER BY n DESC, first) FROM (
          SELECT * FROM {name} ORDER BY n DESC, first LIMIT 8))"""

    out["insights"] = sql(f"""
      SELECT total_records, {rates}, {packed('top_issues')} AS top_issue_categories,
        {packed('top_names')} AS top_companies,
        (SELECT string_agg(finding, '|' ORDER BY place) FROM ({findings})) AS key_findings
      FROM rates""", "top_issues", "top_names", "rates")
    return out

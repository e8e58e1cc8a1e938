"""DuckDB statements for the queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_STOP = """'the','be','to','of','and','that','have','with','is','it','in','for','on','as','was','a',
    'le','la','les','de','des','et','en','un','une','que','est','dans','pour','du',
    'der','die','das','und','zu','den','von','mit','im','ist','ein','eine','auf',
    'el','los','las','y','por','con','para','una','se','del','al'"""


def _ratio(part: str, whole: str) -> str:
    return f"(CASE WHEN {whole} = 0 THEN 0.0::DOUBLE ELSE {part}::DOUBLE / {whole} END)"


def _level(unit: str, source: str, prior: str, keep: str) -> str:
    """A level's posterior rate and weight under its prior, whose weight is fitted by moments."""
    return f"""
        {unit}_w AS (
            SELECT CASE WHEN most > 0 THEN CASE WHEN over_ / most > 0 THEN 1 / (over_ / most) - 1 ELSE 1000.0 END ELSE 2.0 END AS raw
            FROM (SELECT sum(power(bad - n * {prior}, 2) - n * ({prior} * (1 - {prior}))) AS over_,
                         sum(n * (n - 1) * ({prior} * (1 - {prior}))) AS most FROM {source})
        ),
        {unit} AS (
            SELECT {keep}, (bad + w * {prior}) / (n + w) AS {unit}_rate, n + w AS {unit}_weight
            FROM {source}, (SELECT greatest(2.0, least(1000.0, raw)) AS w FROM {unit}_w)
        )
    """


SQL = {
    "op3_url_filters": rf"""
        WITH p AS (
            SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ),
        labelled AS (
            SELECT doc_id, max((quality = 0 OR toxic = 1)::INT) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
        ),
        hosts AS (
            SELECT host, count(bad) AS n, sum(coalesce(bad, 0)) AS bad
            FROM p LEFT JOIN labelled ON doc_id = try_cast(regexp_extract(path, '([0-9]{{1,18}})(?:\.html|/)?$', 1) AS BIGINT)
            GROUP BY host
        ),
        cut AS (SELECT *, string_split(host, '.') AS parts FROM hosts),
        named AS (
            SELECT host, n, bad, array_to_string(parts[-2:], '.') AS two, array_to_string(parts[-3:], '.') AS three, parts[-1] AS one,
                   two IN ('co.uk','org.uk','ac.uk','gov.uk','com.au','net.au','org.au','co.nz','co.jp','com.br','com.cn','co.in',
                           'co.za','com.mx') AS deep,
                   CASE WHEN deep THEN three ELSE two END AS domain, CASE WHEN deep THEN two ELSE one END AS suffix
            FROM cut
        ),
        domain_n AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM named GROUP BY ALL),
        suffix_n AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domain_n GROUP BY ALL),
        suffix_p AS (SELECT *, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM suffix_n) AS prior FROM suffix_n),
        {_level("suffix_r", "suffix_p", "prior", "suffix")},
        domain_p AS (SELECT d.*, suffix_r_rate AS prior FROM domain_n d JOIN suffix_r USING (suffix)),
        {_level("domain_r", "domain_p", "prior", "domain, suffix")},
        host_p AS (SELECT named.*, domain_r_rate AS prior FROM named JOIN domain_r USING (domain, suffix)),
        {_level("host_r", "host_p", "prior", "host")},
        rated AS (
            SELECT host, host_r_rate AS rate, host_r_rate - 1.645 * sqrt(host_r_rate * (1 - host_r_rate) / (host_r_weight + 1)) AS bound FROM host_r
        ),
        ruled AS (
            SELECT *, CASE
                WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
                WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
                WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
                WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
            FROM p
        )
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                    WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict,
               round(rate, 6) AS bad_rate, round(bound, 6) AS bad_bound
        FROM ruled LEFT JOIN rated USING (host)
    """,
    "op5_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_LOWER} AS normal FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(normal) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY normal)
    """,
    "op7_quality_rules": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        s AS (
            SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                   list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM d
        ),
        windows AS (
            SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS three
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM s)
        ),
        again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1),
        repeated AS (
            SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id
        ),
        m AS (
            SELECT doc_id, len(w)::BIGINT AS n_words,
                   coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                   len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                   (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                   coalesce(n, 0)::BIGINT AS n_repeat_words,
                   len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words, len(lines) AS n_lines,
                   len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullet_lines,
                   len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_cut_lines
            FROM s LEFT JOIN repeated USING (doc_id)
        ),
        b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND {_ratio("word_chars", "n_words")} BETWEEN 2.0 AND 16.0
               AND {_ratio("n_symbols", "n_words")} <= 0.1 AND {_ratio("n_stop_words", "n_words")} >= 0.02
               AND {_ratio("n_dup_lines", "n_lines")} <= 0.3 AND {_ratio("n_bullet_lines", "n_lines")} <= 0.9
               AND {_ratio("n_cut_lines", "n_lines")} <= 0.3 AS kept
        FROM b
    """,
    "op11_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
            FROM documents
        ),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS place FROM s),
        w AS (SELECT *, [5, 2, 1][(place - 1) % 3 + 1]::BIGINT AS weight FROM r),
        c AS (
            SELECT *, source_size / weight AS level,
                   150 * sum(source_size) OVER () - 200 * (sum(source_size) OVER up_ - source_size) AS left_,
                   sum(weight) OVER () - sum(weight) OVER up_ + weight AS open_
            FROM w WINDOW up_ AS (ORDER BY source_size / weight, place ROWS UNBOUNDED PRECEDING)
        ),
        f AS (SELECT left_, open_, level AS from_level, place AS from_place FROM c WHERE 200 * source_size * open_ > weight * left_
              ORDER BY level, place LIMIT 1),
        t AS (
            SELECT source, source_size,
                   CASE WHEN from_level IS NOT NULL AND (level, place) >= (from_level, from_place)
                        THEN least(weight * (f.left_::DOUBLE / 100) / f.open_::DOUBLE, 2.0::DOUBLE * source_size)
                        ELSE 2.0::DOUBLE * source_size END AS target
            FROM c LEFT JOIN f ON true
        ),
        p AS (
            SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS before
            FROM d
        ),
        e AS (
            SELECT p.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs,
                   CASE WHEN source_size > 0 THEN floor(target)::BIGINT % source_size ELSE 0 END AS rest
            FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken, source,
               epochs::BIGINT AS epochs
        FROM e
    """,
    "op12_hard_negatives": """
        WITH v AS (
            SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT a.rid AS anchor, a.vec_id AS anchor_id, r.rid AS other, r.vec_id AS other_id, a.label = r.label AS same,
                   list_dot_product(a.q, r.q)::BIGINT AS score
            FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.rid <> r.rid
        ),
        p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) <= 5),
        n AS (
            SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other_id)::INT AS rank
            FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
    """,
    "op13_lexical_search": rf"""
        WITH i AS (
            SELECT item, item_id, unnest(list_distinct(regexp_extract_all({_LOWER}, '{_TERM}'))) AS term
            FROM (SELECT row_number() OVER () AS item, * FROM benchmark)
        ),
        d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS terms FROM documents),
        whole AS (SELECT count(*) FILTER (len(terms) > 0)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d),
        tf AS (
            SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(terms) AS term FROM d)
            WHERE term IN (SELECT term FROM i) GROUP BY ALL
        ),
        w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY term, n_docs),
        m AS (SELECT rid, doc_id, 50 + (50 * len(terms)::BIGINT * n_docs) // n_terms AS m FROM d, whole WHERE len(terms) > 0),
        s AS (
            SELECT item, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
            FROM i JOIN tf USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY ALL
        )
        SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
        FROM s WHERE score > 0 QUALIFY rank <= 50
    """,
}

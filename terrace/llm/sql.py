"""SQL twins of the queries on training data."""

from __future__ import annotations

_TRIM = r"lower(regexp_replace({0}, '^\s+|\s+$', '', 'g'))"
_DRAW = "draw_id, build, max_rank"
_SAME = "a.draw_id IS NOT DISTINCT FROM b.draw_id AND a.build IS NOT DISTINCT FROM b.build AND a.max_rank IS NOT DISTINCT FROM b.max_rank"
_REPORT = f"""WITH valid AS (SELECT build, iri, rank, {_TRIM.format("bucket")} AS cat
    FROM (SELECT *, row_number() OVER (PARTITION BY build, iri ORDER BY loaded_at DESC NULLS LAST) AS r FROM ranked) WHERE r = 1),
  target AS (SELECT DISTINCT {_DRAW}, bucket, {_TRIM.format("bucket")} AS cat, greatest(coalesce(sample_size, 0), 0)::bigint AS size,
    greatest(coalesce(target_permille, 0), 0)::bigint AS w, greatest(coalesce(min_rows, 0), 0)::bigint AS m FROM sample_targets),
  per AS (SELECT {_DRAW}, cat, max(size) AS size, max(w) AS w, max(m) AS m FROM target GROUP BY ALL),
  pooled AS (SELECT per.*, count(iri) AS pool FROM per LEFT JOIN valid ON valid.build = per.build AND valid.cat = per.cat AND valid.rank <= max_rank GROUP BY ALL),
  c AS (SELECT *, least(m, pool) AS low, max(size) OVER (PARTITION BY {_DRAW}) AS s FROM pooled),
  point AS (SELECT DISTINCT {_DRAW}, s, unnest([low / w, pool / w]) AS t FROM c WHERE w > 0),
  reached AS (SELECT a.draw_id, a.build, a.max_rank, a.s, a.t, sum(CASE WHEN w = 0 THEN low ELSE greatest(low, least(pool, w * t)) END) AS f
    FROM point a JOIN c b ON {_SAME} GROUP BY ALL),
  level AS (SELECT {_DRAW}, max(t) AS t FROM reached WHERE f <= s GROUP BY ALL),
  state AS (SELECT a.*, CASE WHEN w = 0 OR b.t IS NULL OR low / w > b.t THEN 'low' WHEN pool / w <= b.t THEN 'full' ELSE 'open' END AS st FROM c a LEFT JOIN level b ON {_SAME}),
  rest AS (SELECT *, s - sum(CASE st WHEN 'low' THEN low WHEN 'full' THEN pool ELSE 0 END) OVER (PARTITION BY {_DRAW}) AS r,
    sum(CASE WHEN st = 'open' THEN w END) OVER (PARTITION BY {_DRAW}) AS ws FROM state),
  part AS (SELECT *, CASE WHEN st = 'open' THEN r * w // ws END AS p, CASE WHEN st = 'open' THEN r * w % ws END AS x FROM rest),
  solved AS (SELECT *, CASE st WHEN 'low' THEN low WHEN 'full' THEN pool ELSE p + (row_number() OVER (PARTITION BY {_DRAW} ORDER BY x DESC NULLS LAST, cat)
    <= r - sum(p) OVER (PARTITION BY {_DRAW}))::int END::bigint AS quota FROM part),
  summed AS (SELECT *, sum(quota) OVER (PARTITION BY {_DRAW}) AS total, sum(w) OVER (PARTITION BY {_DRAW}) AS weights FROM solved),
  report AS (SELECT a.draw_id, a.bucket, greatest(a.m, a.size * a.w // 1000) AS need, pool, quota, CASE WHEN weights > 0 THEN round(b.w / weights, 6) END AS target_share,
    CASE WHEN total > 0 THEN round(quota / total, 6) END AS share,
    CASE WHEN pool < greatest(a.m, a.size * a.w // 1000) THEN 'pool_below_need' WHEN total > a.size THEN 'minimums_exceed_sample'
      WHEN quota = pool AND b.w > 0 AND quota * weights < a.w * a.size THEN 'exhausted' WHEN total < a.size THEN 'draw_exhausted' END AS reason
    FROM target a JOIN summed b ON {_SAME} AND a.cat IS NOT DISTINCT FROM b.cat)"""

_VALID = """valid AS (SELECT build, iri, views::double AS views, languages::double AS languages, score
    FROM (SELECT *, row_number() OVER (PARTITION BY build, iri ORDER BY loaded_at DESC NULLS LAST) AS r FROM ranked) WHERE r = 1)"""
_HIGHER = "rank() OVER (PARTITION BY build ORDER BY {0} DESC NULLS LAST) - 1"
_LEADS = f"""led AS (SELECT *, count(*) OVER (PARTITION BY build) AS n, {_HIGHER.format("views")} AS hv, {_HIGHER.format("languages")} AS hl,
    {_HIGHER.format("score")} AS hs FROM valid),
  lead AS (SELECT build, iri, hv * 50 < n AND hl * 50 < n AND hs * 50 < n AS leads FROM led)"""

_BOUNDED = "-ln(1 + exp(-(x.{0} - med.{0}) / CASE WHEN mad.{0} > 0 THEN mad.{0} * 1.4826 ELSE 1 END)) AS {0}"

_SPACE = r"\t\n\x{0b}\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WS, _SOLID, _BLANK = f"[{_SPACE}]", f"[^{_SPACE}]", f"[{_SPACE.replace(chr(92) + 'n', '', 1)}]"
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_NARROW = "".join(chr(c) for c in range(0x21, 0x7F)).replace("'", "''")

SQL = {
    "p1_found": f"{_REPORT} SELECT draw_id, bucket FROM report WHERE pool < need",
    "p1_report": f"{_REPORT} SELECT *, pool < need AS short FROM report",
    "p1_shares": f"{_REPORT} SELECT draw_id, cat, quota AS drawn, quota AS iris FROM solved WHERE quota > 0",
    "p3_found": """WITH e AS (SELECT DISTINCT entity_id, vector::DOUBLE[] AS v FROM entities
        WHERE len(vector) = 64 AND NOT list_bool_or([isnan(x) OR isinf(x) OR x IS NULL FOR x IN vector]) AND list_dot_product(vector::DOUBLE[], vector::DOUBLE[]) > 0),
      u AS (SELECT entity_id, v, sqrt(list_dot_product(v, v)) AS n FROM e)
      SELECT a.entity_id AS entity_id_a, b.entity_id AS entity_id_b FROM u a JOIN u b ON a.entity_id < b.entity_id
      WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.95""",
    "p3_nearest": """WITH e AS (SELECT DISTINCT entity_id, vector::DOUBLE[] AS v FROM entities
        WHERE len(vector) = 64 AND NOT list_bool_or([isnan(x) OR isinf(x) OR x IS NULL FOR x IN vector]) AND list_dot_product(vector::DOUBLE[], vector::DOUBLE[]) > 0),
      u AS (SELECT entity_id, v, sqrt(list_dot_product(v, v)) AS n FROM e),
      s AS (SELECT a.entity_id AS entity_id, b.entity_id AS neighbour_id, list_dot_product(a.v, b.v) / (a.n * b.n) AS cosine
        FROM u a JOIN u b ON a.entity_id <> b.entity_id WHERE a.entity_id % 100 = 0)
      SELECT entity_id, neighbour_id, row_number() OVER (PARTITION BY entity_id ORDER BY cosine DESC, neighbour_id) AS place, round(cosine, 6) AS cosine
      FROM s QUALIFY place <= 10""",
    "p6_found": f"WITH {_VALID}, {_LEADS} SELECT build, iri FROM lead WHERE leads",
    "p6_ranking": f"""WITH {_VALID}, {_LEADS},
      x AS (SELECT build, iri, ln(1 + views) AS v, ln(1 + languages) AS l, score AS s FROM valid),
      med AS (SELECT build, median(v) AS v, median(l) AS l, median(s) AS s FROM x GROUP BY 1),
      mad AS (SELECT x.build, median(abs(x.v - med.v)) AS v, median(abs(x.l - med.l)) AS l, median(abs(x.s - med.s)) AS s
        FROM x JOIN med ON x.build IS NOT DISTINCT FROM med.build GROUP BY 1),
      q AS (SELECT x.build, x.iri, {", ".join(_BOUNDED.format(c) for c in "vls")}
        FROM x JOIN med ON x.build IS NOT DISTINCT FROM med.build JOIN mad ON x.build IS NOT DISTINCT FROM mad.build),
      low AS (SELECT build, iri, {", ".join(f"coalesce({c}, min({c}) OVER (PARTITION BY build) - ln(2), -ln(2)) AS {c}" for c in "vls")} FROM q),
      f AS (SELECT build, iri, 0.4 * v + 0.3 * l + 0.3 * s AS fused FROM low)
      SELECT f.build, f.iri, rank() OVER (PARTITION BY f.build ORDER BY fused DESC) AS place, round(exp(fused), 9) AS fused, leads
      FROM f JOIN lead ON f.build IS NOT DISTINCT FROM lead.build AND f.iri = lead.iri""",
    "p7_decoded": "SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents",
    "p9_counts": rf"""WITH d AS (SELECT DISTINCT doc_id, lower(lang) AS lang, text FROM documents WHERE text IS NOT NULL),
      t AS (SELECT doc_id, lang, regexp_replace(translate(regexp_replace(regexp_replace(text, '[\x{{ad}}\x{{200b}}]', '', 'g'), '^{_WS}+', ''),
        '{_WIDE}', '{_NARROW}'), '\r\n?|[\x{{2028}}\x{{2029}}\x{{85}}]', chr(10), 'g') AS x FROM d),
      u AS (SELECT *, row_number() OVER () AS k, regexp_replace(x, '{_WS}', '', 'g') AS solid, regexp_extract_all(x, '{_SOLID}+') AS tok,
        len(regexp_extract_all(x, '{_SOLID}[^\n]*')) AS lines, len(regexp_extract_all(x, '[.!?…。]["''”’»)\]]*{_BLANK}*(?:\n|\z)')) AS closed FROM t WHERE regexp_matches(x, '{_SOLID}')),
      w AS (SELECT k, lang, nfc_normalize(regexp_replace(lower(unnest(tok)), '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g')) AS word FROM u),
      c AS (SELECT DISTINCT lower(lang) AS cl, nfc_normalize(lower(word)) AS word FROM common_words WHERE word IS NOT NULL AND lang IS NOT NULL),
      h AS (SELECT k, cl, any_value(w.lang) AS lang, count(*) AS n FROM w JOIN c USING (word) GROUP BY k, cl),
      m AS (SELECT k, CASE WHEN any_value(lang) IN (SELECT cl FROM c) THEN coalesce(max(n) FILTER (cl = lang), 0) ELSE max(n) END AS n FROM h GROUP BY k)
      SELECT DISTINCT doc_id, len(tok) AS words, round(length(solid) / len(tok), 6) AS mean_word_length,
        round(length(regexp_replace(solid, '[\p{{L}}\p{{N}}]', '', 'g')) / length(solid), 6) AS symbol_ratio, round(closed / lines, 6) AS closed_lines,
        round(coalesce(m.n, 0) / len(tok), 6) AS common_share FROM u LEFT JOIN m USING (k)
      UNION ALL SELECT DISTINCT doc_id, 0, NULL, NULL, NULL, NULL FROM documents WHERE text IS NULL OR NOT regexp_matches(text, '{_SOLID}')""",
}

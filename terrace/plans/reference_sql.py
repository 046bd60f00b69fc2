"""SQL twins of the queries in ``reference``."""

from __future__ import annotations

from terrace.plans import reference as R
from terrace.operators.ranking import normalised

RES, ONT, XSD = R.RES, R.ONT, R.XSD
_SPACE = r"[\t-\r\x{85}\p{Z}]+"
_OBJ = "obj AS (SELECT s, p, o FROM mappingbased_objects WHERE o_is_iri AND o IS NOT NULL AND s IS NOT NULL)"
_POOL = """pool AS (SELECT iri, m.bucket AS bucket, m.views AS views, m.languages AS languages FROM (
    SELECT iri, min({'bucket': lower(trim(bucket)), 'views': coalesce(views, 0), 'languages': coalesce(languages, 1)}) AS m FROM entities GROUP BY 1))"""
_SCORED = f"""{_POOL}, st AS (SELECT bucket, avg(ln(1 + views)) AS mv, stddev_samp(ln(1 + views)) AS sv, avg(ln(1 + languages)) AS ml, stddev_samp(ln(1 + languages)) AS sl
    FROM pool GROUP BY 1),
  scored AS (SELECT iri, pool.bucket, views, languages, 0.6 * (ln(1 + views) - mv) / CASE WHEN sv > 0 THEN sv ELSE 1 END
    + 0.4 * (ln(1 + languages) - ml) / CASE WHEN sl > 0 THEN sl ELSE 1 END AS score FROM pool JOIN st ON pool.bucket IS NOT DISTINCT FROM st.bucket)"""
_SHARES = normalised(R.BUCKETS)
_NAMES = ", ".join(f"'{b.name}'" for b in _SHARES)
_VALUES = ", ".join(f"({i}, '{b.name}', {b.share!r}::double)" for i, b in enumerate(_SHARES))
_RANKED = f"""WITH RECURSIVE {_SCORED}, floor_ AS (SELECT * FROM scored WHERE views >= 5000 AND languages >= 5),
  b AS (SELECT * FROM (VALUES {_VALUES}) AS t(ord, bucket, share)),
  size AS (SELECT b.ord, b.bucket, b.share, count(floor_.iri) AS n FROM b LEFT JOIN floor_ USING (bucket) GROUP BY ALL),
  lists AS (SELECT list(share ORDER BY ord) AS shares, list(n ORDER BY ord) AS sizes, list(bucket ORDER BY ord) AS names FROM size),
  step AS (SELECT 0 AS k, 0::bigint AS pick, list_transform(sizes, lambda x: 0::bigint) AS taken FROM lists
    UNION ALL SELECT k + 1, p, list_transform(taken, lambda x, i: x + CASE WHEN i = p THEN 1 ELSE 0 END) FROM (
      SELECT k, taken, list_position(lack, list_max(lack))::bigint AS p FROM (
        SELECT k, taken, list_transform(taken, lambda x, i: CASE WHEN x < sizes[i] THEN shares[i] * (k + 1) - x ELSE -1e300 END) AS lack FROM step, lists
        WHERE k < {R.TIERS[-1]} AND list_sum(taken) < list_sum(sizes)))),
  seq AS (SELECT k AS rank, names[pick] AS bucket, taken[pick] AS pos FROM step, lists WHERE k > 0),
  placed AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY score DESC, iri) AS pos FROM floor_ WHERE bucket IN ({_NAMES})),
  ranked_ AS (SELECT seq.rank::int AS rank, iri, bucket, CASE WHEN seq.rank <= 250 THEN 250 WHEN seq.rank <= 500 THEN 500 ELSE 1000 END::int AS tier_min
    FROM placed JOIN seq USING (bucket, pos))"""
_LINKS = """link AS (SELECT DISTINCT replace(trim(cls, ' \t\n\r'), 'kbo:', 'http://kb.example/ontology/') AS c,
      replace(trim(parent, ' \t\n\r'), 'kbo:', 'http://kb.example/ontology/') AS p, via
    FROM hierarchy_parents WHERE trim(cls, ' \t\n\r') <> '' AND trim(parent, ' \t\n\r') <> '')"""
_REACH = "reach AS (SELECT c, p FROM link UNION SELECT r.c, l.p FROM reach r JOIN link l ON r.p = l.c)"
_LEVEL = """walked AS (SELECT DISTINCT c, p, 1 AS depth FROM link WHERE c <> p UNION
    SELECT w.c, l.p, w.depth + 1 FROM walked w JOIN link l ON w.p = l.c WHERE w.depth < 64 AND l.p <> w.c),
  level AS (SELECT c, p, min(depth) AS depth FROM walked GROUP BY 1, 2)"""
_DOC_LINES = r"line AS (SELECT unnest(string_split_regex(text, '\r\n|\r|\n')) AS l FROM documents WHERE text IS NOT NULL)"
_VIEWS = f"""{_DOC_LINES}, log AS (SELECT string_split(l, ' ') AS f FROM line WHERE contains(l, '.kb ')),
  views AS (SELECT string_split(f[1], '.')[1] AS lang, f[2] AS title, sum(try_cast(f[5] AS bigint))::bigint AS views FROM log
    WHERE ends_with(f[1], '.kb') AND try_cast(f[5] AS bigint) IS NOT NULL AND string_split(f[1], '.')[1] IN ('en', 'de', 'fr', 'nl', 'es', 'sv')
      AND f[4] IN ('desktop', 'mobile-web') GROUP BY 1, 2)"""
_ENGLISH = f"english AS (SELECT DISTINCT iri, entity_id AS q, substr(iri, {len(RES) + 1}) AS title FROM entities)"
_SISTERS = "sister AS (SELECT DISTINCT q, lower(lang) AS lang, title FROM documents JOIN english USING (iri) WHERE lower(lang) <> 'en')"
_NAME = f"replace(url_decode(regexp_replace(CASE WHEN contains(o, '#') THEN regexp_extract(o, '[^#]*$') ELSE regexp_extract(o, '[^/]*$') END, '%([^0-9A-Fa-f]|.[^0-9A-Fa-f]|.?$)', '%25\\1', 'g')), '_', ' ')"


def _walk_sql() -> str:
    prio = " ".join(f"WHEN '{ONT}{p}' THEN {i}" for i, p in enumerate(R.WALK))
    out = f"""{_OBJ}, place0 AS (SELECT DISTINCT '{RES}' || c AS x, '{RES}' || c AS place FROM (SELECT unnest(countries) AS c FROM entities)),
  edge AS (SELECT DISTINCT s, CASE p {prio} END AS prio, o FROM obj WHERE s <> o AND p IN ({', '.join(f"'{ONT}{p}'" for p in R.WALK)}) AND s NOT IN (SELECT x FROM place0))"""
    for h in range(R.HOPS):
        out += f""",
  got{h} AS (SELECT DISTINCT s AS x, prio, place FROM edge JOIN place{h} ON edge.o = place{h}.x),
  place{h + 1} AS (SELECT * FROM place0 UNION SELECT x, place FROM got{h} g WHERE prio = (SELECT min(prio) FROM got{h} m WHERE m.x = g.x))"""
    return out


def _props_sql() -> str:
    t = "CASE WHEN {0} THEN try_cast(regexp_replace(trim({1}), '\\.0+$', '') AS bigint) END"
    cols = []
    for p, (c, kind) in sorted(R.PROPS.items(), key=lambda x: x[1][0]):
        v = f"min(o) FILTER (p = '{p}')"
        if kind == "int":
            v = f"CASE WHEN regexp_full_match(regexp_replace(trim({v}), '\\.0+$', ''), '[+-]?[0-9]+') THEN try_cast(regexp_replace(trim({v}), '\\.0+$', '') AS bigint) END"
        elif kind == "float":
            v = rf"CASE WHEN regexp_full_match(trim({v}), '[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?') THEN try_cast(trim({v}) AS double) END"
        cols.append(f"{v} AS {c}")
    del t
    return ", ".join(cols)


_IN_PROPS = ", ".join(f"'{p}'" for p in R.PROPS)
_WALK = _walk_sql()
_RESOLVE = f"""{_WALK}, place AS (SELECT * FROM place{R.HOPS}), o AS (SELECT DISTINCT s, p, o FROM obj),
  person AS (SELECT x, place FROM (SELECT s AS x, place, k, min(k) OVER (PARTITION BY s) AS m FROM (
      SELECT s, place, CASE p WHEN '{ONT}birthPlace' THEN 0 ELSE 1 END AS k FROM o JOIN place ON o.o = place.x WHERE p IN ('{ONT}birthPlace', '{ONT}country'))) WHERE k = m),
  org AS (SELECT s AS x, place FROM o JOIN place ON o.o = place.x WHERE p = '{ONT}location'),
  ent AS (SELECT DISTINCT iri AS x, grp FROM entities),
  inherited AS (SELECT s, p, v, place FROM (
      SELECT s, p, v, place, j, min(j) OVER (PARTITION BY s, p, v) AS m FROM (
        SELECT s, p, o AS v, place, 0 AS j FROM o JOIN person ON o.o = person.x WHERE p IN ('{ONT}founder', '{ONT}author')
        UNION ALL SELECT s, p, o, place, 1 FROM o JOIN org ON o.o = org.x WHERE p = '{ONT}author')) WHERE j = m),
  tried AS (SELECT ent.x, place, p AS via, CASE grp || ' ' || substr(p, {len(ONT) + 1}) WHEN 'People birthPlace' THEN 0 WHEN 'People country' THEN 1
        WHEN 'Organisations location' THEN 0 WHEN 'Organisations founder' THEN 1 WHEN 'Works author' THEN 0 WHEN 'Works country' THEN 1
        WHEN 'Places isPartOf' THEN 0 WHEN 'Places country' THEN 1 END AS k
      FROM ent JOIN (SELECT s, p, place FROM o JOIN place ON o.o = place.x WHERE p NOT IN ('{ONT}founder', '{ONT}author')
        UNION ALL SELECT s, p, place FROM inherited) h ON ent.x = h.s),
  best AS (SELECT x, place, via FROM (SELECT *, min(k) OVER (PARTITION BY x) AS m FROM tried WHERE k IS NOT NULL) WHERE k = m),
  self AS (SELECT DISTINCT ent.x, place, 'self' AS via FROM ent JOIN place ON ent.x = place.x AND place.x = place.place),
  resolved AS (SELECT x, list_sort(list(DISTINCT place)) AS places, min(via) AS via FROM (
      SELECT * FROM self UNION ALL SELECT * FROM best WHERE x NOT IN (SELECT x FROM self)) GROUP BY x)"""

_TRIPLE = r"""(?s)^\s*(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(<[^>]*>|_:\S+|"(?:.*)"(?:@(?:[A-Za-z0-9-]+)|\^\^<(?:[^>]*)>)?)\s*\.\s*\z"""
# IRIs without a percent sign, of any scheme
_IRI_SQL = r"""CASE WHEN starts_with({0}, 'https://') OR (starts_with({0}, 'http://') AND ends_with({0}, '/'))
    THEN regexp_replace('http://' || lower(regexp_extract({0}, '^https?://([^/]*)', 1)) || regexp_extract({0}, '^https?://[^/]*(.*)\z', 1), '([^/])/+\z', '\1')
    WHEN regexp_matches({0}, '^http://[^/]*[A-Z]') THEN 'http://' || lower(regexp_extract({0}, '^http://([^/]*)', 1)) || regexp_extract({0}, '^http://[^/]*(.*)\z', 1) ELSE {0} END"""
_PART_TYPES = """WITH RECURSIVE edge AS (SELECT p_brand || '/' || p_type AS c, p_type AS p FROM part UNION SELECT p_type, 'Part' FROM part
    UNION SELECT * FROM (VALUES ('Part', 'Thing'), ('Part', 'Item'), ('Item', 'Part'))),
  up AS (SELECT c, p FROM edge UNION SELECT up.c, edge.p FROM up JOIN edge ON up.p = edge.c),
  inst AS (SELECT p_partkey AS iri, p_brand || '/' || p_type AS type FROM part),
  inferred AS (SELECT iri, type FROM inst UNION ALL SELECT iri, p FROM inst JOIN up ON up.c = inst.type)"""
_LABELS = """edge AS (SELECT DISTINCT 'label' || label AS c, CASE WHEN label % 2 = 1 THEN 'odd' ELSE 'even' END AS p FROM embeddings
    UNION SELECT CASE WHEN label % 2 = 1 THEN 'odd' ELSE 'even' END, 'any' FROM embeddings),
  up AS (SELECT c, p FROM edge UNION SELECT up.c, edge.p FROM up JOIN edge ON up.p = edge.c),
  member AS (SELECT DISTINCT vec_id FROM embeddings JOIN up ON up.c = 'label' || label WHERE up.p = 'odd')"""

SQL = {
    "candidate_pool": f"""WITH {_OBJ}, typed AS (SELECT iri, min(t) AS type FROM (SELECT iri, unnest(types) AS t FROM entities) GROUP BY 1),
      txt AS (SELECT iri, min({{'abstract': a, 'title': title}}) AS m FROM (SELECT iri, title, trim(regexp_replace(abstract, '{_SPACE}', ' ', 'g')) AS a FROM entities)
        WHERE length(a) >= 40 GROUP BY 1)
      SELECT iri, m.title AS title, type, lower(type) AS bucket, m.abstract AS abstract FROM typed JOIN txt USING (iri)
      WHERE iri NOT IN (SELECT o FROM obj WHERE p = '{ONT}successor') AND NOT starts_with(m.title, 'The ')""",
    "dedup_first": "SELECT min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY text",
    "type_counts": "SELECT bucket, grp, count(*) AS n, count(DISTINCT iri) AS entities FROM entities GROUP BY 1, 2",
    "edition_languages": """SELECT iri, count(DISTINCT lower(lang)) AS languages,
      count(DISTINCT lower(lang)) FILTER (lower(lang) IN ('de', 'fr', 'nl', 'es', 'sv')) AS target_editions FROM documents WHERE iri IS NOT NULL GROUP BY 1""",
    "monthly_views": "SELECT strftime(ts, '%Y-%m') AS month, event_type, count(*) AS n, round(sum(value), 4) AS views FROM events GROUP BY 1, 2",
    "redirect_canon": f"""WITH {_OBJ}, r AS (SELECT DISTINCT o AS source, regexp_replace(o, '[?#].*', '', 's') AS target FROM obj WHERE regexp_matches(o, '[?#]'))
      SELECT coalesce(target, o) AS o, count(*) AS n FROM obj LEFT JOIN r ON o = source GROUP BY 1""",
    "country_distribution": "SELECT country, count(*) AS n FROM (SELECT unnest(countries) AS country FROM entities) GROUP BY 1",
    "top_titles": """SELECT bucket, rank, title, iri FROM (SELECT iri, m.bucket AS bucket, m.rank AS rank, m.title AS title FROM (
        SELECT iri, min({'bucket': bucket, 'rank': rank, 'title': title}) AS m FROM entities WHERE rank IS NOT NULL AND bucket IS NOT NULL GROUP BY 1))
      QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY rank, iri) <= 20""",
    "edges_in_tier": f"""WITH {_OBJ}, m AS (SELECT DISTINCT iri FROM entities WHERE tier_min IS NOT NULL)
      SELECT DISTINCT s, p, o FROM obj WHERE s IN (SELECT iri FROM m) AND o IN (SELECT iri FROM m)""",
    "dangling_edges": f"WITH {_OBJ} SELECT p, count(*) AS n FROM obj WHERE o NOT IN (SELECT iri FROM entities) GROUP BY 1",
    "object_labels": f"""WITH {_OBJ} SELECT s AS iri, substr(p, {len(ONT) + 1}) || '_label' AS name, string_agg({_NAME}, '|' ORDER BY {_NAME}) AS labels
      FROM obj WHERE p IN ('{ONT}country', '{ONT}location', '{ONT}genre') GROUP BY 1, 2""",
    "props_pivot": f"SELECT s AS iri, {_props_sql()} FROM mappingbased_literals WHERE p IN ({_IN_PROPS}) AND s IN (SELECT iri FROM entities) GROUP BY 1",
    "props_struct": f"""WITH {_OBJ}, w AS (SELECT s AS iri, {_props_sql()} FROM mappingbased_literals WHERE p IN ({_IN_PROPS}) GROUP BY 1),
      l AS (SELECT s AS iri, string_agg({_NAME}, '|' ORDER BY {_NAME}) AS country_label FROM obj WHERE p = '{ONT}country' GROUP BY 1)
      SELECT coalesce(w.iri, l.iri) AS iri, birthdate, populationtotal, country_label FROM w FULL JOIN l ON w.iri = l.iri""",
    "wide_entities": f"""{_RANKED}, t AS (SELECT iri, min(title) AS title, max(len(vector)) AS dims FROM entities GROUP BY 1),
      w AS (SELECT s AS iri, {_props_sql()} FROM mappingbased_literals WHERE p IN ({_IN_PROPS}) GROUP BY 1)
      SELECT r.iri, r.rank, r.tier_min, t.title, w.populationtotal, w.birthdate, t.dims FROM ranked_ r LEFT JOIN t USING (iri) LEFT JOIN w USING (iri)""",
    "iri_normalize": r"""SELECT DISTINCT s, CASE WHEN regexp_matches(trim(s), '^https?://[^/]') THEN 'http://' || lower(regexp_extract(trim(s), '^https?://([^/]*)', 1))
        || CASE WHEN length(regexp_extract(trim(s), '^https?://[^/]*(.*)$', 1)) > 1
          THEN regexp_replace(url_decode(regexp_extract(trim(s), '^https?://[^/]*(.*)$', 1)), '/+$', '') ELSE regexp_extract(trim(s), '^https?://[^/]*(.*)$', 1) END
        ELSE trim(s) END AS iri FROM mappingbased_literals""",
    "nt_roundtrip": "SELECT doc_id, text, 'en' AS lang FROM documents WHERE text <> ''",
    "parsed_lines": rf"""WITH got AS (SELECT regexp_extract(line, '{_TRIPLE}', 1) AS s, regexp_extract(line, '{_TRIPLE}', 2) AS p, regexp_extract(line, '{_TRIPLE}', 3) AS o FROM raw_lines
        WHERE NOT regexp_matches(line, '^\s*(#|\z)') AND regexp_matches(line, '{_TRIPLE}')),
      iri AS (SELECT {_IRI_SQL.format("{'s': CASE WHEN starts_with(s, '<') THEN substr(s, 2, length(s) - 2) ELSE s END}.s")} AS s, {_IRI_SQL.format("p")} AS p, starts_with(o, '<') AS o_is_iri FROM got)
      SELECT p, o_is_iri, count(*) AS n, count(DISTINCT s) AS subjects FROM iri GROUP BY 1, 2""",
    "pageview_log": f"WITH {_VIEWS} SELECT lang, title, views FROM views",
    "entity_views": f"""WITH views AS (SELECT lower(lang) AS lang, substr(iri, {len(RES) + 1}) AS title, sum(coalesce(n_chars, 0)) AS views FROM documents WHERE iri IS NOT NULL GROUP BY 1, 2),
      {_ENGLISH}, {_SISTERS},
      page AS (SELECT iri, 'en' AS lang, title FROM english UNION ALL SELECT english.iri, sister.lang, sister.title FROM english JOIN sister USING (q))
      SELECT iri, sum(views)::bigint AS views FROM page JOIN views USING (lang, title) GROUP BY 1""",
    "edition_links": f"WITH {_ENGLISH}, {_SISTERS} SELECT 'Q' || q AS q, count(DISTINCT lang) AS languages FROM sister WHERE NOT contains(title, ':') GROUP BY 1",
    "abox_lines": r"""SELECT DISTINCT value FROM (
        SELECT CASE WHEN starts_with(s, '_:') THEN s ELSE '<' || s || '>' END || ' <' || p || '> "' || replace(replace(replace(replace(replace(o, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') || '"'
          || CASE WHEN datatype IS NULL THEN '@' || coalesce(lang, 'en') ELSE '^^<' || datatype || '>' END || ' .' AS value FROM mappingbased_literals WHERE s IS NOT NULL AND o IS NOT NULL
        UNION ALL SELECT CASE WHEN starts_with(s, '_:') THEN s ELSE '<' || s || '>' END || ' <' || p || '> <' || o || '> .' FROM mappingbased_objects
          WHERE o_is_iri AND o IS NOT NULL AND s IS NOT NULL)""",
    "import_lines": f"""WITH {_OBJ}, {_LINKS} SELECT 'SUBCLASS ' || c || ' ' || p AS value FROM (SELECT DISTINCT c, p FROM link)
      UNION ALL SELECT DISTINCT 'INSTANCE ' || iri || ' ' || t FROM (SELECT iri, unnest(types) AS t FROM entities)
      UNION ALL SELECT DISTINCT 'PROPERTY ' || s || ' ' || p || ' ' || o FROM obj""",
    "typed_literals": rf"""WITH k AS (SELECT p, min(coltype) AS kind FROM attributes GROUP BY 1)
      SELECT CASE kind WHEN 'int' THEN '{XSD}integer' WHEN 'float' THEN '{XSD}double' ELSE CASE WHEN regexp_full_match(o, '-?\d{{4}}-\d{{2}}-\d{{2}}') THEN '{XSD}date'
        WHEN regexp_full_match(o, '-?\d{{4}}') THEN '{XSD}gYear' END END AS inferred, datatype, count(*) AS n FROM mappingbased_literals LEFT JOIN k USING (p) WHERE o IS NOT NULL GROUP BY 1, 2""",
    "class_levels": f"WITH RECURSIVE {_LINKS}, {_LEVEL} SELECT c AS cls, p AS ancestor, depth FROM level WHERE c <> p",
    "class_closure": f"WITH RECURSIVE {_LINKS}, {_REACH} SELECT c AS cls, p AS ancestor FROM reach WHERE c <> p",
    "bucket_assign": f"""WITH RECURSIVE {_LINKS}, {_LEVEL}, root AS (SELECT p AS root FROM (SELECT DISTINCT c, p FROM link) GROUP BY 1 HAVING count(*) >= 5),
      way AS (SELECT DISTINCT c AS cls, c AS a, 0 AS depth FROM link UNION SELECT DISTINCT p, p, 0 FROM link UNION SELECT c, p, depth FROM level)
      SELECT cls, sha256(a) AS bucket FROM way JOIN root ON way.a = root.root QUALIFY row_number() OVER (PARTITION BY cls ORDER BY depth, a) = 1""",
    "inferred_types": f"{_PART_TYPES} SELECT iri, type FROM inferred",
    "class_extent": f"{_PART_TYPES} SELECT type, count(*) AS members FROM inferred GROUP BY 1",
    "class_members": f"{_PART_TYPES} SELECT iri FROM inferred WHERE type = 'Item' ORDER BY iri LIMIT 100",
    "closure_diff": f"""WITH RECURSIVE {_LINKS}, {_REACH}, sub AS (SELECT DISTINCT c, p FROM link WHERE via = 'subClassOf'),
      reach2 AS (SELECT c, p FROM sub UNION SELECT r.c, l.p FROM reach2 r JOIN sub l ON r.p = l.c)
      SELECT c AS cls, p AS ancestor, 'left' AS side FROM (SELECT c, p FROM reach WHERE c <> p EXCEPT SELECT c, p FROM reach2 WHERE c <> p)
      UNION ALL SELECT c, p, 'right' FROM (SELECT c, p FROM reach2 WHERE c <> p EXCEPT SELECT c, p FROM reach WHERE c <> p)""",
    "walk_up": f"WITH {_WALK} SELECT x, place FROM place{R.HOPS}",
    "resolve_ordered": f"WITH {_RESOLVE} SELECT x, array_to_string(places, '|') AS places, via FROM resolved",
    "geography_gate": f"""WITH {_RESOLVE}, target AS (SELECT list(x) AS t FROM (SELECT x FROM place0 ORDER BY x LIMIT 8)),
      e AS (SELECT iri AS x, max(languages) AS editions FROM entities GROUP BY 1),
      j AS (SELECT e.x, editions, via, places IS NOT NULL AS known, list_sort(list_filter(coalesce(places, []), lambda y: list_contains(t, y))) AS hits
        FROM e LEFT JOIN resolved USING (x), target)
      SELECT x, len(hits) > 0 OR (NOT known AND editions >= 4) AS passes, CASE WHEN len(hits) > 0 THEN via WHEN known THEN 'non_target_country'
        WHEN editions >= 4 THEN 'unresolved_editions' ELSE 'unresolved' END AS reason, array_to_string(hits, '|') AS places FROM j""",
    "tbox_clean": f"""WITH {_LINKS} SELECT DISTINCT c AS s, via AS p, p AS o, CASE WHEN via = 'subClassOf' AND p NOT IN (SELECT cls FROM hierarchy_classes) THEN 'undeclared_parent'
        WHEN regexp_matches(c || p, '[^\\x00-\\x7F]') THEN 'non_ascii' WHEN via = 'equivalentClass' THEN 'equivalence' END AS rule FROM link""",
    "el_split": f"""WITH o AS (SELECT s, p, o, o_is_iri FROM mappingbased_objects WHERE s IS NOT NULL AND o IS NOT NULL),
      bl AS (SELECT s, p, o FROM o WHERE NOT o_is_iri AND starts_with(o, '_:')),
      t AS (SELECT s, p, o FROM o WHERE o_is_iri UNION ALL SELECT * FROM bl UNION ALL SELECT o, p, s FROM bl),
      bad AS (SELECT DISTINCT s AS b FROM t WHERE starts_with(s, '_:') AND p IN ('{ONT}country', '{ONT}author'))
      SELECT CASE WHEN p = '{ONT}genre' THEN 'predicate:{ONT}genre' WHEN s IN (SELECT b FROM bad) THEN 'in_expression'
        WHEN o IN (SELECT b FROM bad) THEN 'points_at_expression' END AS reason, count(*) AS n FROM t GROUP BY 1""",
    "tbox_counts": f"""WITH RECURSIVE {_LINKS}, {_REACH} SELECT 'declared' AS what, count(DISTINCT cls) AS n FROM hierarchy_classes
      UNION ALL SELECT 'nodes', count(*) FROM (SELECT c FROM link UNION SELECT p FROM link)
      UNION ALL SELECT 'subsumptions', count(*) FROM reach WHERE c <> p""",
    "bucket_zscore_rank": f"WITH {_SCORED} SELECT iri, bucket, views, languages, round(score, 6) AS score FROM scored WHERE views >= 5000 AND languages >= 5",
    "interleave_tiers": f"{_RANKED} SELECT rank, iri, bucket, tier_min FROM ranked_",
    "tier_prefix_counts": f"{_RANKED} SELECT tier_min, bucket, count(*) AS n, max(rank) AS last_rank FROM ranked_ GROUP BY 1, 2",
    "preflight_demand": f"""WITH {_SCORED}, b AS (SELECT * FROM (VALUES {_VALUES}) AS t(ord, bucket, share)),
      c AS (SELECT b.bucket, share, count(iri) AS pool, count(iri) FILTER (views >= 5000 AND languages >= 5) AS above_floor FROM b LEFT JOIN scored USING (bucket) GROUP BY ALL)
      SELECT bucket, pool, above_floor, round_even(share * {R.TIERS[-1]}, 0)::bigint AS demand, greatest(round_even(share * {R.TIERS[-1]}, 0)::bigint - above_floor, 0) AS shortfall FROM c""",
    "knn": """SELECT a.vec_id AS probe, b.vec_id AS id, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) DESC, b.vec_id) AS place,
        round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS score FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
      WHERE a.vec_id % 100 = 0 QUALIFY place <= 10""",
    "knn_class_scoped": f"""WITH RECURSIVE {_LABELS} SELECT a.vec_id AS probe, b.vec_id AS id, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) DESC, b.vec_id) AS place,
        round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS score FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND b.vec_id IN (SELECT vec_id FROM member)
      WHERE a.vec_id % 100 = 0 QUALIFY place <= 5""",
    "vector_checks": """SELECT count(*) AS vectors, count(*) FILTER (coalesce(len(vector), 0) <> 64) AS wrong_dims,
      count(*) FILTER (len(vector) = 64 AND (list_bool_or([isnan(x) FOR x IN vector]) OR NOT coalesce(abs(sqrt(list_dot_product(vector::DOUBLE[], vector::DOUBLE[])) - 1) <= 0.001, false))) AS not_unit FROM entities""",
    "embedded_test_vectors": "SELECT DISTINCT iri, 64 AS dims, 1.0::double AS norm FROM entities",
    "token_cost": """SELECT count(*) AS entities, sum(length(title) + 1 + length(abstract))::bigint AS chars, floor(sum(length(title) + 1 + length(abstract)) / 4.06)::bigint AS tokens,
      floor(sum(length(title) + 1 + length(abstract)) / 4.06) * 0.02 / 1e6 AS price FROM entities WHERE title IS NOT NULL AND abstract IS NOT NULL""",
    "tier_checks": f"""{_RANKED}, tier AS (SELECT * FROM (VALUES (250), (500), (1000)) AS t(tier)),
      a AS (SELECT tier, count(iri) AS n, count(DISTINCT iri) AS iris, count(DISTINCT rank) AS ranks, coalesce(max(rank), 0) AS last, coalesce(min(rank), 1) AS first,
        coalesce(max(tier_min), 0) AS most, count(*) FILTER (iri IS NOT NULL AND NOT regexp_matches(iri, '^https?://[^\\s<>"{{}}|\\\\^`]+$')) AS odd
        FROM tier LEFT JOIN ranked_ ON rank <= tier GROUP BY 1),
      lost AS (SELECT a.tier, b.tier AS last, count(*) FILTER (iri NOT IN (SELECT iri FROM ranked_ x WHERE x.rank <= a.tier)) AS n
        FROM tier a JOIN tier b ON b.tier * 2 = a.tier LEFT JOIN ranked_ ON tier_min <= b.tier GROUP BY 1, 2)
      SELECT tier, 'full' AS "check", n = tier AS passed FROM a UNION ALL SELECT tier, 'unique', n = iris FROM a UNION ALL SELECT tier, 'conforming', odd = 0 FROM a
      UNION ALL SELECT tier, 'dense', ranks = n AND first = 1 AND last = n FROM a UNION ALL SELECT tier, 'within', most <= tier FROM a
      UNION ALL SELECT tier, 'holds_' || last, n = 0 FROM lost""",
}

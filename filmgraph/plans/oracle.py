"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement restates the derivation of the inputs (FIXTURES.md section 3) and every parsing,
building and query rule in plain SQL over the driver tables, independently of the Spark code.
"""

from __future__ import annotations

from .. import schemas as S
from . import reports as R

# ---------------------------------------------------------------- rule snippets

# JVM trim: every character up to U+0020 (NUL aside, which SQL text cannot hold).
_TRIM = "(" + " || ".join(f"chr({i})" for i in range(1, 33)) + ")"


def jtrim(x: str) -> str:
    return f"trim({x}, {_TRIM})"


def jsplit(x: str, sep: str) -> str:
    """Split on one character, trailing empty items dropped; only separators -> []."""
    q = "\\" + sep
    return (f"(CASE WHEN regexp_matches({x}, '^{q}+$') THEN []::VARCHAR[] "
            f"ELSE string_split(regexp_replace({x}, '{q}+$', ''), '{sep}') END)")


def split_trim(x: str, sep: str) -> str:
    return f"list_transform({jsplit(x, sep)}, lambda s: {jtrim('s')})"


_TITLE_RE = r"^(.*)\s+\((\d{4})\)$"


def name_parts(x: str) -> str:
    return split_trim(f"replace({x}, ')', '')", "(")


def name_of(x: str) -> str:
    p = name_parts(x)
    return f"(CASE WHEN len({p}) IN (1, 2) THEN ({p})[1] ELSE {x} END)"


def notes_of(x: str) -> str:
    p = name_parts(x)
    return f"(CASE WHEN len({p}) = 2 THEN ({p})[2] END)"


def jstr(key: str) -> str:
    return (f"(CASE WHEN json_type(response, '$.{key}') = 'VARCHAR' "
            f"THEN json_extract_string(response, '$.{key}') END)")


def dbl(x: str) -> str:
    return f"(CASE WHEN {x} = 0 THEN 0.0::DOUBLE ELSE CAST({x} AS DOUBLE) END)"


def joined(x: str, sort: bool = False) -> str:
    return f"array_to_string({'list_sort(' + x + ')' if sort else x}, '|')"


_JVM_FLOAT_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# ---------------------------------------------------------------- input derivations (fixed)

CTE = {
    "fx_movies": """
SELECT CAST(p_partkey AS BIGINT) movieId,
 CASE p_partkey % 10 WHEN 0 THEN p_name
   WHEN 1 THEN concat('  ',p_name,' (',CAST(1950+p_size AS STRING),')  ')
   WHEN 2 THEN concat(p_name,' (2006-2007)')
   ELSE concat(p_name,' (',CAST(1950+p_size AS STRING),')') END title,
 CASE p_partkey % 7 WHEN 0 THEN '(no genres listed)'
   WHEN 1 THEN concat(' ',p_type,' | ',p_brand,'|')
   WHEN 2 THEN concat(p_type,'|',p_type)
   ELSE concat(p_type,'|',p_brand) END genres
FROM part""",
    "fx_ratings": """
SELECT CAST(o_custkey AS BIGINT) userId, CAST(l_partkey AS BIGINT) movieId,
 l_quantity/10 rating, CAST(epoch(l_shipdate) AS BIGINT) AS timestamp
FROM lineitem JOIN orders ON l_orderkey=o_orderkey""",
    "fx_tags": """
SELECT DISTINCT CAST(substr(p_brand,7) AS BIGINT) tagId, p_brand tag FROM part""",
    "fx_scores": """
SELECT CAST(l_partkey AS BIGINT) movieId, CAST(1+l_suppkey%25 AS BIGINT) tagId,
 max(l_discount)*10 relevance
FROM lineitem GROUP BY 1,2""",
    "fx_links": """
SELECT CAST(p_partkey AS STRING) movieId, lpad(CAST(p_partkey AS STRING),7,'0') imdbId,
 CASE WHEN p_partkey%7=0 THEN NULL ELSE CAST(100000+p_partkey AS STRING) END tmdbId FROM part""",
    "fx_omdb": """
SELECT CAST(p_partkey AS STRING) movieId, lpad(CAST(p_partkey AS STRING),7,'0') imdbId,
 CASE WHEN p_partkey%11=0 THEN NULL
  WHEN p_partkey%13=0 THEN '{"Response":"False","Error":"Incorrect IMDb ID."}'
  ELSE concat('{"Title":"',p_name,'","Rated":',CASE WHEN p_partkey%5=0 THEN '5' ELSE '"PG"' END,
   ',"Director":"',s_name,'","Writer":"',s_name,' (story by), ',s_name,' (screenplay by)',
   '","Actors":"',c_name,', Actor ',CAST(p_partkey%17 AS STRING),
   '","Language":"',CASE WHEN p_partkey%3=0 THEN 'English, French' ELSE 'English' END,
   '","Country":"',n_name,
   '","BoxOffice":"',CASE WHEN p_partkey%4=0 THEN 'N/A'
      ELSE concat('$',CAST(1+p_size AS STRING),',000,000') END,
   '","Metascore":"',CASE WHEN p_partkey%6=0 THEN 'N/A' ELSE CAST(p_size*2 AS STRING) END,
   '","imdbRating":"',CAST(1+p_size%9 AS STRING),'.',CAST(p_partkey%10 AS STRING),
   '","imdbVotes":"',CAST(1+p_size AS STRING),',',lpad(CAST(p_partkey%1000 AS STRING),3,'0'),
   '","Response":"True"}') END response
FROM part LEFT JOIN (
   SELECT l_partkey, arg_max(l_suppkey, l_orderkey*16+l_linenumber) AS sk,
     arg_max(o_custkey, l_orderkey*16+l_linenumber) AS ck
   FROM lineitem JOIN orders ON l_orderkey=o_orderkey GROUP BY l_partkey) x ON l_partkey=p_partkey
 JOIN supplier ON s_suppkey=coalesce(sk, p_partkey%10)
 JOIN customer ON c_custkey=coalesce(ck, p_partkey%150) JOIN nation ON n_nationkey=p_partkey%25""",
}

# ---------------------------------------------------------------- derived tables

CTE["fx_parsed"] = f"""
SELECT movieId,
 CASE WHEN regexp_matches(t, '{_TITLE_RE}') THEN regexp_extract(t, '{_TITLE_RE}', 1) ELSE t END
   AS title,
 CASE WHEN regexp_matches(t, '{_TITLE_RE}') THEN CAST(regexp_extract(t, '{_TITLE_RE}', 2) AS BIGINT)
   END AS year,
 {split_trim('genres', '|')} AS genres
FROM (SELECT movieId, {jtrim('title')} AS t, genres FROM fx_movies)"""

CTE["fx_movie_v"] = """
SELECT movieId, title, year, list_distinct(genres) AS genres FROM fx_parsed"""

CTE["fx_answers"] = """
SELECT CAST(movieId AS BIGINT) AS movieId, imdbId, response,
 CASE WHEN response IS NULL THEN 'unfetched'
      WHEN json_type(response) <> 'OBJECT' OR json_type(response, '$.Response') IS NULL
        THEN 'malformed'
      WHEN json_type(response, '$.Response') = 'VARCHAR'
        AND json_extract_string(response, '$.Response') = 'False' THEN 'failure'
      ELSE 'ok' END AS status
FROM fx_omdb"""

_DIGITS = "regexp_replace({x}, '[^0-9.]+', '', 'g')"


def _money(x: str) -> str:
    return f"TRY_CAST({_DIGITS.format(x=x)} AS FLOAT)"


def _jvm_float(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '{_JVM_FLOAT_RE}') THEN TRY_CAST({x} AS FLOAT) END)"


def _votes(x: str) -> str:
    d = _DIGITS.format(x=x)
    return f"(CASE WHEN regexp_matches({d}, '^[0-9]+$') THEN TRY_CAST({d} AS BIGINT) END)"


CTE["fx_records"] = f"""
SELECT movieId, imdbId, {jstr('Rated')} AS rated,
 {split_trim(jstr('Director'), ',')} AS directors,
 {split_trim(jstr('Writer'), ',')} AS writers,
 {split_trim(jstr('Actors'), ',')} AS actors,
 {split_trim(jstr('Language'), ',')} AS languages,
 {split_trim(jstr('Country'), ',')} AS countries,
 {_money(jstr('BoxOffice'))} AS boxOffice,
 {_jvm_float(jstr('Metascore'))} AS metascore,
 {_jvm_float(jstr('imdbRating'))} AS imdbScore,
 {_votes(jstr('imdbVotes'))} AS imdbVotes
FROM fx_answers WHERE status = 'ok'"""

CTE["fx_items"] = " UNION ALL ".join(
    f"SELECT movieId, '{kind}' AS kind, unnest({kind}) AS item FROM fx_records"
    for kind in ("directors", "writers", "actors", "languages", "countries"))

CTE["fx_credits"] = f"""
SELECT movieId, kind, item, {name_of('item')} AS name, {notes_of('item')} AS notes
FROM fx_items"""

CTE["fx_enriched"] = """
SELECT m.movieId, m.title, m.year, m.genres,
 r.imdbId AS imdbId, TRY_CAST(l.tmdbId AS BIGINT) AS tmdbId, r.rated,
 r.boxOffice, r.metascore, r.imdbScore, r.imdbVotes
FROM fx_movie_v m
LEFT JOIN fx_records r ON r.movieId = m.movieId
LEFT JOIN fx_links l ON CAST(l.movieId AS BIGINT) = m.movieId"""

# Table per label, as SQL over the CTEs: vertex key column(s) and edge src/dst/properties.
VERTEX_SQL = {
    "MOVIE": "SELECT movieId, imdbId AS movieImdbId, tmdbId AS movieTmdbId FROM fx_enriched",
    "YEAR": "SELECT DISTINCT year AS yearNumber FROM fx_parsed WHERE year IS NOT NULL",
    "GENRE": "SELECT DISTINCT g AS genreName FROM (SELECT unnest(genres) AS g FROM fx_parsed)",
    "TAG": "SELECT tagId, tag AS tagName FROM fx_tags",
    "USER": "SELECT DISTINCT userId FROM fx_ratings",
}
_KIND = {"DIRECTOR": "directors", "WRITER": "writers", "ACTOR": "actors",
         "LANGUAGE": "languages", "COUNTRY": "countries"}
for _label, _kind in _KIND.items():
    VERTEX_SQL[_label] = (f"SELECT DISTINCT name AS {S.VERTICES[_label].key} "
                          f"FROM fx_credits WHERE kind = '{_kind}'")

EDGE_SQL = {
    "RELEASED_IN": "SELECT movieId AS src, year AS dst FROM fx_parsed WHERE year IS NOT NULL",
    "CATEGORIZED_AS": "SELECT movieId AS src, unnest(genres) AS dst FROM fx_parsed",
    "RATED_AS": ("SELECT userId AS src, movieId AS dst, CAST(rating AS FLOAT) AS score, "
                 "timestamp FROM fx_ratings"),
    "ESTIMATED_AT": ("SELECT tagId AS src, movieId AS dst, CAST(relevance AS FLOAT) AS relevance "
                     "FROM fx_scores"),
}
_EDGE_KIND = {"DIRECTED_BY": "directors", "WRITTEN_BY": "writers", "ACTED_BY": "actors",
              "SPOKEN_IN": "languages", "PRODUCED_IN": "countries"}
for _label, _kind in _EDGE_KIND.items():
    _fwd = S.EDGES[_label].src == "MOVIE"
    EDGE_SQL[_label] = (
        f"SELECT {'movieId' if _fwd else 'name'} AS src, {'name' if _fwd else 'movieId'} AS dst, "
        f"notes FROM fx_credits WHERE kind = '{_kind}'")


def with_ctes(body: str) -> str:
    """Prefix the statement with every CTE (DuckDB drops the ones it does not use)."""
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in CTE.items()) + "\n" + body


def with_graph(body: str) -> str:
    """Prefix the statement with every CTE plus one ``v_<label>`` / ``e_<label>`` per table."""
    parts = ([f"{n} AS ({sql})" for n, sql in CTE.items()]
             + [f"v_{label.lower()} AS ({sql})" for label, sql in VERTEX_SQL.items()]
             + [f"e_{label.lower()} AS ({sql})" for label, sql in EDGE_SQL.items()])
    return "WITH " + ",\n".join(parts) + "\n" + body


# ---------------------------------------------------------------- the statements

SQL: dict[str, str] = {}

SQL["movie_titles"] = with_ctes("SELECT movieId AS movie_id, title, year FROM fx_parsed")
SQL["movie_genre_lists"] = with_ctes(
    f"SELECT movieId AS movie_id, {joined('genres')} AS genres, CAST(len(genres) AS BIGINT) AS n "
    "FROM fx_parsed")
SQL["movie_vertices"] = with_ctes(
    f"SELECT movieId AS movie_id, title, year, {joined('genres', True)} AS genres FROM fx_movie_v")
SQL["year_vertices"] = with_graph("SELECT yearNumber AS year_number FROM v_year ORDER BY 1")
SQL["genre_vertices"] = with_graph("SELECT genreName AS genre_name FROM v_genre ORDER BY 1")
SQL["released_in_edges"] = with_graph("SELECT src, dst FROM e_released_in")
SQL["categorized_as_edges"] = with_graph("SELECT src, dst FROM e_categorized_as")
SQL["user_vertices"] = with_graph("SELECT userId AS user_id FROM v_user")
SQL["rated_movies"] = with_ctes("SELECT DISTINCT movieId AS movie_id FROM fx_ratings")
SQL["rated_as_edges"] = with_graph(
    f"SELECT src, dst, {dbl('score')} AS score, timestamp FROM e_rated_as")
SQL["streamed_rated_as_edges"] = SQL["rated_as_edges"]
SQL["tag_vertices"] = with_graph("SELECT tagId AS tag_id, tagName AS tag_name FROM v_tag")
SQL["scored_movies"] = with_ctes("SELECT DISTINCT movieId AS movie_id FROM fx_scores")
SQL["estimated_at_edges"] = with_graph(
    f"SELECT src, dst, {dbl('relevance')} AS relevance FROM e_estimated_at")
SQL["link_refs"] = with_ctes(
    "SELECT CAST(movieId AS BIGINT) AS movie_id, concat('tt', imdbId) AS imdb_ref, "
    "TRY_CAST(tmdbId AS BIGINT) AS tmdb_id FROM fx_links")
SQL["omdb_scalars"] = with_ctes(
    f"SELECT movieId AS movie_id, imdbId AS imdb_id, rated, {dbl('boxOffice')} AS box_office, "
    f"{dbl('metascore')} AS metascore, {dbl('imdbScore')} AS imdb_score, "
    "imdbVotes AS imdb_votes FROM fx_records")
SQL["omdb_lists"] = with_ctes(
    "SELECT movieId AS movie_id, "
    + ", ".join(f"{joined(c)} AS {c}" for c in ("directors", "writers", "actors", "languages",
                                                  "countries"))
    + " FROM fx_records")
SQL["omdb_counters"] = with_ctes(
    "SELECT CASE status WHEN 'ok' THEN 'parse_successes' WHEN 'failure' THEN 'parse_failures' "
    "ELSE status END AS metric, count(*) AS n FROM fx_answers GROUP BY status")
SQL["omdb_entity_counts"] = with_ctes(
    "SELECT kind, count(DISTINCT item) AS n_raw, count(DISTINCT name) AS n_names "
    "FROM fx_credits GROUP BY kind")
for _label in _KIND:
    SQL[f"{_label.lower()}_vertices"] = with_graph(
        f"SELECT {S.VERTICES[_label].key} AS name FROM v_{_label.lower()}")
for _label in _EDGE_KIND:
    SQL[f"{_label.lower()}_edges"] = with_graph(f"SELECT src, dst, notes FROM e_{_label.lower()}")
SQL["movies_enriched"] = with_ctes(
    f"SELECT movieId AS movie_id, title, year, {joined('genres', True)} AS genres, "
    f"imdbId AS imdb_id, tmdbId AS tmdb_id, rated, {dbl('boxOffice')} AS box_office, "
    f"{dbl('metascore')} AS metascore, {dbl('imdbScore')} AS imdb_score, "
    "imdbVotes AS imdb_votes FROM fx_enriched")


def _unique_part(label: str, prop: str) -> str:
    return (
        f"SELECT '{label}' AS label, '{prop}' AS property, CAST(sum(n) AS BIGINT) AS n_rows, "
        "CAST(coalesce(sum(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS n_null, "
        "CAST(count(k) AS BIGINT) AS n_keys, "
        "CAST(count(*) FILTER (WHERE k IS NOT NULL AND n > 1) AS BIGINT) AS n_duplicated "
        f"FROM (SELECT {prop} AS k, count(*) AS n FROM v_{label.lower()} GROUP BY 1)")


SQL["unique_key_report"] = with_graph(" UNION ALL ".join(
    _unique_part(label, prop) for label, spec in S.VERTICES.items() for prop in spec.unique))


def _reference_part(label: str, col: str, vlabel: str) -> str:
    key = S.VERTICES[vlabel].key
    return (
        f"SELECT '{label}' AS label, '{col}' AS endpoint, CAST(count(*) AS BIGINT) AS n_edges, "
        "CAST(count(*) FILTER (WHERE v.k IS NULL) AS BIGINT) AS n_dangling_edges, "
        "CAST(count(DISTINCT e.k) FILTER (WHERE v.k IS NULL) AS BIGINT) AS n_dangling_keys "
        f"FROM (SELECT {col} AS k FROM e_{label.lower()}) e "
        f"LEFT JOIN (SELECT DISTINCT {key} AS k FROM v_{vlabel.lower()}) v ON e.k = v.k")


SQL["reference_report"] = with_graph(" UNION ALL ".join(
    _reference_part(label, col, vl) for label, spec in S.EDGES.items()
    for col, vl in (("src", spec.src), ("dst", spec.dst))))

SQL["lookup_unique_keys"] = with_graph(
    "SELECT movieId AS movie_id, movieTmdbId AS tmdb_id FROM v_movie "
    "WHERE movieTmdbId IN (SELECT TRY_CAST(tmdbId AS BIGINT) FROM fx_links)")
SQL["movies_by_title_year_rated"] = with_ctes(
    f"SELECT 'movieTitle' AS index_key, movieId AS movie_id FROM fx_enriched "
    f"WHERE title = '{R.TITLE}' UNION ALL "
    f"SELECT 'movieYear', movieId FROM fx_enriched WHERE year = {R.YEAR} UNION ALL "
    f"SELECT 'movieRated', movieId FROM fx_enriched WHERE rated = '{R.RATED}'")
SQL["movies_by_genre"] = with_ctes(
    f"SELECT movieId AS movie_id, title FROM fx_movie_v WHERE list_contains(genres, '{R.GENRE}')")
SQL["ratings_by_score"] = with_graph(
    f"SELECT src, dst, {dbl('score')} AS score, timestamp FROM e_rated_as "
    f"WHERE score = CAST({R.SCORE} AS FLOAT)")
SQL["ratings_in_range"] = with_graph(
    f"SELECT src, dst, {dbl('score')} AS score, timestamp FROM e_rated_as "
    f"WHERE score BETWEEN CAST({R.SCORE_RANGE[0]} AS FLOAT) AND CAST({R.SCORE_RANGE[1]} AS FLOAT) "
    f"AND timestamp >= {R.TIME_RANGE[0]} AND timestamp < {R.TIME_RANGE[1]}")
SQL["relevant_tags"] = with_graph(
    f"SELECT src, dst, {dbl('relevance')} AS relevance FROM e_estimated_at "
    f"WHERE relevance >= CAST({R.MIN_RELEVANCE} AS FLOAT)")
SQL["movie_search_numeric"] = with_ctes(
    "SELECT movieId AS movie_id, title FROM fx_enriched "
    "WHERE year >= 1980 AND year < 1990 AND CAST(imdbScore AS DOUBLE) >= 5.0 "
    "AND imdbVotes > 20000 AND boxOffice IS NOT NULL AND tmdbId IS NOT NULL")


def _tokens(x: str) -> str:
    return (f"list_filter(regexp_split_to_array(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), "
            "lambda t: t <> '')")


SQL["movie_search_text"] = with_ctes(" UNION ALL ".join([
    f"SELECT 'title_token' AS search, movieId AS movie_id FROM fx_enriched "
    f"WHERE list_contains({_tokens('title')}, 'ring')",
    f"SELECT 'title_token_prefix', movieId FROM fx_enriched "
    f"WHERE len(list_filter({_tokens('title')}, lambda t: starts_with(t, 'wid'))) > 0",
    f"SELECT 'title_token_regex', movieId FROM fx_enriched "
    f"WHERE len(list_filter({_tokens('title')}, lambda t: regexp_full_match(t, 'g.*r'))) > 0",
    "SELECT 'title_prefix', movieId FROM fx_enriched WHERE starts_with(title, 'blue')",
    "SELECT 'title_regex', movieId FROM fx_enriched "
    "WHERE regexp_full_match(title, '.*\\(\\d{4}-\\d{4}\\)')",
    f"SELECT 'genre_token', movieId FROM fx_enriched WHERE len(list_filter(genres, "
    f"lambda g: list_contains({_tokens('g')}, 'promo'))) > 0",
    f"SELECT 'rated_token', movieId FROM fx_enriched WHERE list_contains({_tokens('rated')}, 'pg')",
]))
SQL["tag_search"] = with_graph(
    f"SELECT tagId AS tag_id, tagName AS tag_name FROM v_tag WHERE tagId >= 5 AND tagId < 15 "
    f"AND len(list_filter({_tokens('tagName')}, lambda t: regexp_full_match(t, '1[0-9]'))) > 0")
SQL["neighbours_out"] = with_graph(
    "SELECT e.dst AS genre_name, CAST(count(*) AS BIGINT) AS bulk FROM e_categorized_as e "
    "JOIN fx_parsed m ON e.src = m.movieId "
    f"WHERE m.year >= {R.YEAR_RANGE[0]} AND m.year < {R.YEAR_RANGE[1]} GROUP BY 1")
SQL["neighbours_in"] = with_graph(
    "SELECT r.src AS user_id, CAST(count(*) AS BIGINT) AS bulk FROM e_categorized_as c "
    f"JOIN e_rated_as r ON r.dst = c.src WHERE c.dst = '{R.START_GENRE}' GROUP BY 1")
SQL["two_hop_from_user"] = with_graph(
    "SELECT b.src AS user_id, 2 AS hops, CAST(count(*) AS BIGINT) AS bulk FROM e_rated_as a "
    f"JOIN e_rated_as b ON b.dst = a.dst WHERE a.src = {R.START_USER} GROUP BY 1")
SQL["top_co_raters"] = with_graph(
    "SELECT b.src AS user_id, CAST(count(*) AS BIGINT) AS bulk FROM e_rated_as a "
    f"JOIN e_rated_as b ON b.dst = a.dst WHERE a.src = {R.START_USER} GROUP BY 1 "
    f"ORDER BY bulk DESC, user_id LIMIT {R.TOP_K}")
SQL["genre_movies_in_years"] = with_graph(
    "SELECT m.movieId AS movie_id, m.title, m.year, CAST(count(*) AS BIGINT) AS bulk "
    "FROM e_categorized_as c JOIN fx_enriched m ON c.src = m.movieId "
    f"WHERE c.dst = '{R.START_GENRE}' AND m.year >= {R.YEAR_RANGE[0]} "
    f"AND m.year < {R.YEAR_RANGE[1]} GROUP BY 1, 2, 3")
SQL["high_ratings_of_user"] = with_graph(
    f"SELECT src, dst, {dbl('score')} AS score, timestamp, CAST(1 AS BIGINT) AS bulk "
    f"FROM e_rated_as WHERE src = {R.START_USER} AND score >= CAST(4.0 AS FLOAT)")
SQL["user_degrees"] = with_graph(
    "SELECT src AS user_id, CAST(count(*) AS BIGINT) AS degree FROM e_rated_as GROUP BY 1")
SQL["graph_roundtrip"] = with_graph(" UNION ALL ".join(
    [f"SELECT 'vertex' AS kind, '{label}' AS label, CAST(count(*) AS BIGINT) AS n "
     f"FROM v_{label.lower()}" for label in S.VERTICES]
    + [f"SELECT 'edge', '{label}', CAST(count(*) AS BIGINT) FROM e_{label.lower()}"
       for label in S.EDGES]))
SQL["fetch_missing_fake"] = with_ctes(
    "SELECT CAST(l.movieId AS BIGINT) AS movie_id, l.imdbId AS imdb_id, "
    "CAST(l.imdbId AS BIGINT) % 5 <> 0 AS has_response FROM fx_links l "
    "WHERE l.movieId NOT IN (SELECT movieId FROM fx_omdb WHERE response IS NOT NULL)")


# ---------------------------------------------------------------- planted faults, later additions

SQL["duplicate_keys"] = with_ctes("""
, t AS (SELECT tagId, tag FROM fx_tags
  UNION SELECT tagId, concat(tag, '-b') FROM fx_tags WHERE tagId % 5 = 0),
d AS (SELECT *, count(*) OVER (PARTITION BY tagId) AS n FROM t)
SELECT tagId AS tag_id, tag AS tag_name,
  CASE WHEN n > 1 THEN 'duplicate or null tagId' END AS reason FROM d""")
SQL["dangling_ratings"] = with_ctes("""
SELECT userId AS src, movieId AS dst, CAST(CAST(rating AS FLOAT) AS DOUBLE) AS rating, timestamp,
  CASE WHEN movieId % 17 = 0 THEN 'no vertex for dst' END AS reason FROM fx_ratings""")
SQL["link_rejects"] = with_ctes("""
, f AS (SELECT CASE WHEN CAST(movieId AS BIGINT) % 19 = 0 THEN concat('x', movieId) ELSE movieId END
    AS movieId, imdbId, CASE WHEN CAST(movieId AS BIGINT) % 23 = 0 THEN 'abc'
    WHEN CAST(movieId AS BIGINT) % 41 = 0 THEN '5' ELSE tmdbId END AS tmdbId FROM fx_links
  UNION ALL SELECT concat('0', movieId), imdbId, '7' FROM fx_links
    WHERE CAST(movieId AS BIGINT) % 31 = 0
  UNION ALL SELECT concat(movieId, '00000000'), imdbId, NULL FROM fx_links
    WHERE CAST(movieId AS BIGINT) % 37 = 0 AND movieId <> '0'),
c AS (SELECT TRY_CAST(movieId AS BIGINT) AS movie_id, imdbId AS imdb_id,
    TRY_CAST(tmdbId AS BIGINT) AS tmdb_id, tmdbId FROM f),
r AS (SELECT movie_id, imdb_id, tmdb_id, nullif(concat_ws('; ',
    CASE WHEN movie_id IS NULL THEN 'bad movieId' END,
    CASE WHEN tmdb_id IS NULL AND tmdbId IS NOT NULL THEN 'bad tmdbId' END), '') AS bad FROM c),
u AS (SELECT *, CASE WHEN bad IS NULL AND count(*) FILTER (bad IS NULL) OVER (PARTITION BY movie_id)
    > 1 THEN 'duplicate or null movieId' END AS dup FROM r),
m AS (SELECT *, CASE WHEN bad IS NULL AND dup IS NULL
    AND movie_id NOT IN (SELECT movieId FROM fx_movies) THEN 'no vertex for movieId' END AS gone
    FROM u),
t AS (SELECT *, bad IS NULL AND dup IS NULL AND gone IS NULL AS fine FROM m),
s AS (SELECT *, count(*) FILTER (fine) OVER (PARTITION BY tmdb_id) AS n FROM t)
SELECT movie_id, imdb_id, tmdb_id, coalesce(bad, dup, gone,
  CASE WHEN tmdb_id IS NOT NULL AND n > 1 THEN 'duplicate or null tmdbId' END) AS reason
FROM s""")
SQL["quarantined_inputs"] = with_ctes("""
SELECT CASE WHEN ok THEN userId END AS user_id,
  CASE WHEN ok AND userId % 23 <> 0 THEN movieId END AS movie_id,
  CASE WHEN ok AND userId % 13 <> 0 THEN CAST(rating AS DOUBLE) END AS rating,
  CASE WHEN ok THEN timestamp END AS ts, reason, CAST(count(*) AS BIGINT) AS n
FROM (SELECT *, userId % 17 <> 0 AND userId % 19 <> 0 AS ok,
    CASE WHEN userId % 17 = 0 OR userId % 19 = 0 THEN 'malformed line'
    ELSE nullif(concat_ws('; ', CASE WHEN userId % 23 = 0 THEN 'missing movieId' END,
      CASE WHEN userId % 13 = 0 THEN 'bad rating' END), '') END AS reason FROM fx_ratings)
GROUP BY ALL""")
SQL["movie_search_float_bounds"] = with_ctes(" UNION ALL ".join(
    f"SELECT '{name}' AS search, movieId AS movie_id FROM fx_enriched WHERE {where}"
    for name, where in {
        "equal": "imdbScore = CAST(8.7 AS FLOAT)",
        "within": "imdbScore IN (CAST(8.7 AS FLOAT), CAST(8.3 AS FLOAT))",
        "without": "imdbScore NOT IN (CAST(8.7 AS FLOAT), CAST(8.3 AS FLOAT))",
        "between": "imdbScore >= CAST(8.3 AS FLOAT) AND imdbScore < CAST(8.7 AS FLOAT)",
        "inside": "imdbScore > CAST(8.3 AS FLOAT) AND imdbScore < CAST(9 AS FLOAT)",
        "outside": "imdbScore < CAST(1.3 AS FLOAT) OR imdbScore > CAST(8.7 AS FLOAT)",
        "lookup": "imdbScore IN (CAST(2.3 AS FLOAT), CAST(2.7 AS FLOAT))"}.items()))
SQL["omdb_refetch_counters"] = with_ctes("""
SELECT CASE status WHEN 'ok' THEN 'parse_successes' WHEN 'failure' THEN 'parse_failures'
  ELSE status END AS metric, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN status = 'unfetched' AND movieId % 2 = 0 THEN 'ok' ELSE status END AS status
  FROM fx_answers) GROUP BY 1""")
SQL["traversal_edge_chain"] = with_graph(
    "SELECT c.dst AS genre_name, CAST(count(*) AS BIGINT) AS bulk FROM e_rated_as r "
    f"JOIN e_categorized_as c ON c.src = r.dst WHERE r.src = {R.START_USER} "
    "AND r.score >= CAST(4.0 AS FLOAT) GROUP BY 1")
SQL["both_neighbours"] = with_graph(" UNION ALL ".join(
    f"SELECT '{spec.dst if near == 'src' else spec.src}' AS label, "
    f"CAST({'dst' if near == 'src' else 'src'} AS VARCHAR) AS key, "
    f"CAST(count(*) AS BIGINT) AS bulk FROM e_{label.lower()} "
    f"WHERE {near} IN ({', '.join(map(str, R.START_MOVIES))}) GROUP BY 1, 2"
    for label, spec in S.EDGES.items() for near in ("src", "dst")
    if getattr(spec, near) == "MOVIE"))
SQL["ratings_stream_then_reload"] = SQL["rated_as_edges"]

# ---------------------------------------------------------------- labelled patterns, several labels

SQL["pattern_co_raters"] = with_graph(
    f"SELECT a.dst AS movie, b.src AS other, {dbl('a.score')} AS mine_score, "
    f"{dbl('b.score')} AS theirs_score, CAST(count(*) AS BIGINT) AS bulk "
    "FROM e_rated_as a JOIN e_rated_as b ON a.dst = b.dst "
    f"WHERE a.src = {R.START_USER} AND b.score >= CAST(4.0 AS FLOAT) GROUP BY ALL")
SQL["pattern_genre_years"] = with_graph(
    "SELECT c.dst AS genre, y.dst AS year, CAST(count(*) AS BIGINT) AS bulk "
    "FROM e_categorized_as c JOIN e_released_in y ON y.src = c.src "
    "JOIN e_rated_as r ON r.dst = c.src GROUP BY ALL")
SQL["pattern_matches_per_movie"] = with_graph(
    "SELECT m.movieId AS movie_id, CAST(count(*) AS BIGINT) AS bulk FROM fx_parsed m "
    "JOIN e_rated_as r ON r.dst = m.movieId JOIN e_estimated_at t ON t.dst = m.movieId "
    "JOIN e_categorized_as c ON c.src = m.movieId "
    f"WHERE m.year >= {R.YEAR_RANGE[0]} AND m.year < {R.YEAR_RANGE[1]} "
    "AND t.relevance >= CAST(0.5 AS FLOAT) GROUP BY ALL")
SQL["edges_of_several_labels"] = with_graph(
    "SELECT label, src, dst, CAST(count(*) AS BIGINT) AS n FROM (" + " UNION ALL ".join(
        f"SELECT '{label}' AS label, CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst "
        f"FROM e_{label.lower()} WHERE {near} IN ({', '.join(map(str, R.START_MOVIES))})"
        for label, spec in S.EDGES.items() for near in ("src", "dst")
        if getattr(spec, near) == "MOVIE") + ") GROUP BY ALL")


# ---------------------------------------------------------------- edge ids

def _edge_id(label: str) -> str:
    """Content hash over the columns' lengths and texts, and the place among equal edges."""
    texts, columns = [], S.EDGES[label].schema.fieldNames()
    for f in S.EDGES[label].schema.fields:
        x = dbl(f.name) if f.dataType.typeName() == "float" else f.name
        x = f"CAST({x} AS VARCHAR)"
        texts.append(f"coalesce(concat(length({x}), ':', {x}), '-')")
    # concat skips nulls in DuckDB
    texts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE {t} END"
             for c, t in zip(columns, texts, strict=True)]
    return (f"concat('{label}:', md5({' || '.join(texts)}), ':', row_number() OVER "
            f"(PARTITION BY {', '.join(columns)}) - 1)")


SQL["edge_ids"] = with_graph(" UNION ALL ".join(
    f"SELECT '{label}' AS label, {_edge_id(label)} AS edge_id, CAST(src AS VARCHAR) AS src, "
    f"CAST(dst AS VARCHAR) AS dst FROM e_{label.lower()}" for label in ("RATED_AS", "WRITTEN_BY")))
SQL["edge_by_id"] = with_graph(
    f"SELECT {_edge_id('RATED_AS')} AS edge_id, src, dst, {dbl('score')} AS score, timestamp "
    f"FROM e_rated_as WHERE src = {R.START_USER}")


# ---------------------------------------------------------------- postings and the curve copy

_GENRE = "len(list_filter(genres, lambda g: {})) > 0"
SQL["movie_search_postings"] = with_graph(" UNION ALL ".join(
    [f"SELECT '{name}' AS search, movieId AS id FROM fx_enriched WHERE {where}"
     for name, where in {
        "title_contains": "contains(title, 'ring')",
        "title_starts": "starts_with(title, 'blue w')",
        "title_regex": "regexp_full_match(title, '(blue|green) (wid|gi).*')",
        "title_regex_any": "regexp_full_match(title, '.*[0-9].*')",
        "imdb_regex": r"regexp_full_match(imdbId, '00000\d7')",
        "imdb_contains": "contains(imdbId, '00123')",
        "rated_regex": "regexp_full_match(rated, 'P.?G')",
        "rated_word": f"list_contains({_tokens('rated')}, 'pg')",
        "genre_contains": _GENRE.format("contains(g, 'CONO')"),
        "genre_regex": _GENRE.format("regexp_full_match(g, 'Brand#1[0-4]')"),
        "genre_word_prefix": _GENRE.format(
            f"len(list_filter({_tokens('g')}, lambda t: starts_with(t, 'pro'))) > 0"),
     }.items()]
    + ["SELECT 'tag_contains', tagId FROM v_tag WHERE contains(tagName, 'nd#2')"]))
SQL["movie_search_ranges"] = with_ctes(" UNION ALL ".join(
    f"SELECT '{name}' AS search, movieId AS movie_id FROM fx_enriched WHERE {where}"
    for name, where in {
        "two": "year >= 1960 AND year < 1970 AND imdbScore > CAST(2.5 AS FLOAT) "
               "AND imdbScore < CAST(6.5 AS FLOAT)",
        "three": "year >= 1955 AND year < 1985 AND NOT (imdbScore >= CAST(0 AS FLOAT) "
                 "AND imdbScore < CAST(5 AS FLOAT)) AND imdbVotes >= 0 AND imdbVotes < 30000",
        "one": "imdbVotes > 10000 AND imdbVotes < 20000",
        "null": "metascore IS NULL AND year >= 1980 AND year < 1982"}.items()))

SQL["omdb_entity_estimates"] = with_ctes(
    "SELECT kind, count(DISTINCT item) AS n_raw, count(DISTINCT name) AS n_names, "
    "true AS raw_near, true AS names_near FROM fx_credits GROUP BY kind")
SQL["late_rated_as_edges"] = SQL["rated_as_edges"]

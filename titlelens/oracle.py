"""Independent SQL statement of every registered question (DuckDB dialect),
over the same catalogue derivation written as CTEs.

These follow the question definitions directly (window lags, outer joins,
per-row explodes) rather than the Spark plans' rewrites (telescoped sums,
pre-aggregation, one-pass counts), so agreement checks the rewrites too.
Dialect notes: DuckDB's ``CAST(double AS INT)`` rounds, so truncation is
written ``trunc``; default null ordering differs from Spark, so it is
always spelled out; rank functions are cast to INTEGER as in Spark.
"""

from __future__ import annotations

from titlelens.sources.derived import CATEGORIES, DANGLING_TITLE, GENRES, LANGUAGES, TITLE_TYPES
from titlelens.sources.schemas import SCHEMAS

CATALOG_CTES = f"""
title_basics AS (
  SELECT concat('tt', k) AS tconst,
         split_part('{TITLE_TYPES}', ',', CAST(k % 5 + 1 AS INTEGER)) AS titleType,
         CASE WHEN k % 2 = 0 THEN concat('Title ', k % 700) ELSE concat('Title ', k % 1000000000) END AS primaryTitle,
         concat('Original ', k) AS originalTitle,
         CAST(CASE WHEN k % 53 = 0 THEN NULL WHEN k % 17 = 0 THEN 1 ELSE 0 END AS INTEGER) AS isAdult,
         CAST(CASE WHEN k % 41 = 0 THEN NULL ELSE 1900 + k % 126 END AS INTEGER) AS startYear,
         CAST(NULL AS INTEGER) AS endYear,
         CAST(CASE WHEN k % 23 = 0 THEN NULL WHEN k % 31 = 0 THEN 0 ELSE 40 + k % 140 END AS INTEGER) AS runtimeMinutes,
         CASE WHEN k % 29 = 0 THEN NULL
              WHEN k % 3 = 0 THEN g0
              WHEN k % 3 = 1 THEN concat(g0, ',', g1)
              ELSE concat(g0, ',', g1, ',', g2) END AS genres
  FROM (SELECT o_orderkey AS k,
               split_part('{GENRES}', ',', CAST(o_orderkey % 8 + 1 AS INTEGER)) AS g0,
               split_part('{GENRES}', ',', CAST((o_orderkey + 3) % 8 + 1 AS INTEGER)) AS g1,
               split_part('{GENRES}', ',', CAST((o_orderkey + 5) % 8 + 1 AS INTEGER)) AS g2
        FROM orders) o
),
title_ratings AS (
  SELECT concat('tt', o_orderkey) AS tconst,
         CAST(1.0 + CAST((o_orderkey * 7) % 91 AS DOUBLE) / 10 AS FLOAT) AS averageRating,
         CAST(floor(o_totalprice) AS INTEGER) AS numVotes
  FROM orders WHERE o_orderkey % 10 <> 9
),
title_crew AS (
  SELECT concat('tt', k) AS tconst,
         CASE WHEN k % 37 = 0 THEN NULL
              WHEN k % 4 = 1 THEN concat('nm', c, ',nm', (c * 7 + 3) % nc)
              ELSE concat('nm', c) END AS directors,
         CASE WHEN k % 19 = 0 THEN NULL
              WHEN k % 4 = 2 THEN concat('nm', (c + 1) % nc, ',nm', (c + 2) % nc)
              ELSE concat('nm', (c + k % 2) % nc) END AS writers
  FROM (SELECT o_orderkey AS k, o_custkey AS c, (SELECT count(*) FROM customer) AS nc FROM orders) o
),
title_episode AS (
  SELECT concat('tt', o_orderkey) AS tconst,
         concat('tt', o_orderkey - o_orderkey % 100 + 2) AS parentTconst,
         CAST(CASE WHEN o_orderkey % 47 = 0 THEN NULL
                   ELSE 1 + (o_orderkey % 100 - o_orderkey % 25) % 4 END AS INTEGER) AS seasonNumber,
         CAST(o_orderkey % 25 AS INTEGER) AS episodeNumber
  FROM orders WHERE o_orderkey % 5 = 3
),
title_principals AS (
  SELECT concat('tt', l_orderkey) AS tconst, CAST(l_linenumber AS INTEGER) AS ordering,
         concat('nm', l_partkey) AS nconst,
         CASE WHEN l_suppkey % 13 = 0 THEN NULL
              ELSE split_part('{CATEGORIES}', ',', CAST(l_suppkey % 5 + 1 AS INTEGER)) END AS category,
         CAST(NULL AS VARCHAR) AS job,
         CASE WHEN l_partkey % 5 = 0 THEN NULL
              WHEN l_orderkey % 43 = 0 THEN concat('["Role ', l_orderkey % 300, '"')
              WHEN l_orderkey % 29 = 0 THEN '[]'
              WHEN l_orderkey % 3 = 0 THEN concat('["Role ', l_orderkey % 300, '","Self"]')
              ELSE concat('["Role ', l_orderkey % 300, '"]') END AS characters
  FROM lineitem
),
title_akas AS (
  SELECT concat('tt', l_orderkey) AS titleId, CAST(l_linenumber AS INTEGER) AS ordering,
         concat('Aka ', l_orderkey) AS title,
         CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE n_name END AS region,
         CASE WHEN l_partkey % 11 = 0 THEN NULL
              ELSE split_part('{LANGUAGES}', ',', CAST(l_partkey % 6 + 1 AS INTEGER)) END AS language,
         CAST(NULL AS VARCHAR) AS types, CAST(NULL AS VARCHAR) AS attributes,
         CAST(0 AS INTEGER) AS isOriginalTitle
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
),
name_basics AS (
  SELECT concat('nm', c_custkey) AS nconst,
         concat(c_mktsegment, ' ', c_custkey % 40) AS primaryName,
         CAST(NULL AS INTEGER) AS birthYear, CAST(NULL AS INTEGER) AS deathYear,
         CASE c_custkey % 4 WHEN 0 THEN 'actor,producer' WHEN 1 THEN 'actress'
                            WHEN 2 THEN 'director,writer' ELSE NULL END AS primaryProfession,
         CASE WHEN c_custkey % 13 = 0 THEN NULL
              WHEN c_custkey % 7 = 0 THEN concat('tt', c_custkey % 60, ',{DANGLING_TITLE}')
              ELSE concat('tt', c_custkey % 60, ',tt', c_custkey % 45) END AS knownForTitles
  FROM customer
)"""

MOVIE_GENRES = """(SELECT tconst, unnest(string_split(genres, ',')) AS genre
   FROM title_basics WHERE titleType = 'movie' AND genres IS NOT NULL)"""

QUESTIONS_SQL = {
    "top_rated_titles": """
SELECT b.tconst, b.primaryTitle, b.originalTitle, b.startYear, b.genres, r.averageRating, r.numVotes
FROM title_basics b JOIN title_ratings r ON b.tconst = r.tconst
WHERE b.titleType = 'movie' AND r.numVotes >= 10000
ORDER BY r.averageRating DESC NULLS LAST, r.numVotes DESC NULLS LAST, b.tconst ASC NULLS FIRST
LIMIT 20""",

    "most_credited_people": """,
counts AS (
  SELECT p.nconst, count(*) AS episode_count
  FROM title_principals p JOIN title_basics b ON p.tconst = b.tconst
  WHERE p.category IN ('actor', 'actress') AND b.titleType = 'tvEpisode'
  GROUP BY p.nconst),
pool AS (SELECT * FROM counts ORDER BY episode_count DESC, nconst ASC NULLS FIRST LIMIT 50)
SELECT pool.nconst, n.primaryName, pool.episode_count
FROM pool JOIN name_basics n ON pool.nconst = n.nconst
ORDER BY pool.episode_count DESC, pool.nconst ASC
LIMIT 20""",

    "most_credited_named_people": """
SELECT p.nconst, any_value(n.primaryName) AS primaryName, count(*) AS episode_count
FROM title_principals p JOIN title_basics b ON p.tconst = b.tconst JOIN name_basics n ON p.nconst = n.nconst
WHERE p.category IN ('actor', 'actress') AND b.titleType = 'tvEpisode'
GROUP BY p.nconst
ORDER BY episode_count DESC, p.nconst ASC
LIMIT 20""",

    "titles_per_category_approx": """
SELECT category, count(DISTINCT tconst) AS distinct_movies, true AS within_bound
FROM title_principals WHERE category IS NOT NULL
GROUP BY category""",

    "titles_by_type": """
SELECT titleType, count(*) AS title_count,
       count(numVotes) AS rated_count, max(numVotes) AS most_votes
FROM title_basics LEFT JOIN title_ratings USING (tconst)
GROUP BY titleType""",

    "rating_by_genre": """
SELECT genre, avg(averageRating) AS avg_rating, count(*) AS movie_count
FROM (SELECT unnest(string_split(b.genres, ',')) AS genre, r.averageRating
      FROM title_basics b JOIN title_ratings r ON b.tconst = r.tconst
      WHERE b.titleType = 'movie' AND b.startYear > 2010 AND b.genres IS NOT NULL) x
GROUP BY genre
HAVING count(*) >= 10""",

    "improving_directors": """,
credits AS (
  SELECT unnest(string_split(k.directors, ',')) AS director_id, b.startYear, r.averageRating
  FROM title_crew k JOIN title_basics b ON k.tconst = b.tconst JOIN title_ratings r ON b.tconst = r.tconst
  WHERE k.directors IS NOT NULL AND b.titleType = 'movie' AND r.numVotes >= 1000),
named AS (
  SELECT c.director_id, n.primaryName AS director_name, c.startYear, c.averageRating
  FROM credits c JOIN name_basics n ON c.director_id = n.nconst),
yearly AS (
  SELECT director_id, director_name, startYear, avg(averageRating) AS avg_rating
  FROM named GROUP BY director_id, director_name, startYear),
trends AS (
  SELECT director_id, director_name, avg_rating - prev_year_avg AS rating_trend
  FROM (SELECT *, lag(avg_rating) OVER (PARTITION BY director_id ORDER BY startYear ASC NULLS FIRST) AS prev_year_avg
        FROM yearly) y
  WHERE prev_year_avg IS NOT NULL),
per AS (
  SELECT director_id, director_name, avg(rating_trend) AS avg_rating_trend, count(*) AS years_with_movies
  FROM trends GROUP BY director_id, director_name)
SELECT director_id, director_name, avg_rating_trend, years_with_movies
FROM per WHERE avg_rating_trend > 0 AND years_with_movies >= 3
ORDER BY avg_rating_trend DESC, director_id ASC
LIMIT 20""",

    "non_english_languages": """
SELECT a.language, count(*) AS movie_count
FROM title_basics b JOIN title_akas a ON b.tconst = a.titleId
WHERE b.titleType = 'movie' AND a.language IS NOT NULL AND a.language <> 'en'
GROUP BY a.language
ORDER BY movie_count DESC, a.language ASC
LIMIT 20""",

    "runtime_by_decade": """,
d AS (
  SELECT CAST(trunc(startYear / 10) AS INTEGER) * 10 AS decade, avg(runtimeMinutes) AS avg_runtime,
         count(*) AS movie_count
  FROM title_basics
  WHERE titleType = 'movie' AND runtimeMinutes IS NOT NULL AND runtimeMinutes > 0
    AND startYear IS NOT NULL AND startYear > 1900
  GROUP BY 1),
l AS (SELECT *, lag(avg_runtime) OVER (ORDER BY decade) AS prev_decade_runtime FROM d)
SELECT decade, avg_runtime, movie_count, prev_decade_runtime,
       avg_runtime - prev_decade_runtime AS runtime_change,
       CASE WHEN prev_decade_runtime IS NOT NULL
            THEN (avg_runtime - prev_decade_runtime) / prev_decade_runtime * 100 END AS runtime_change_percent
FROM l""",

    "lead_director_genre_counts": """,
j AS (
  SELECT string_split(b.genres, ',') AS genre_list, b.genres,
         string_split(k.directors, ',')[1] AS director
  FROM title_basics b JOIN title_crew k ON b.tconst = k.tconst
  WHERE b.titleType = 'movie' AND b.genres IS NOT NULL AND k.directors IS NOT NULL),
counts AS (
  SELECT genre_list, any_value(genres) AS genres, director, count(*) AS movie_count
  FROM j GROUP BY genre_list, director)
SELECT c.genre_list[1] AS lead_genre, n.primaryName AS director, c.movie_count
FROM counts c LEFT JOIN name_basics n ON c.director = n.nconst
ORDER BY c.movie_count DESC, c.genres ASC, c.director ASC NULLS FIRST
LIMIT 20""",

    "director_writer_pairs": """
SELECT d.primaryName AS director_name, w.primaryName AS writer_name, count(*) AS collaboration_count
FROM title_basics b JOIN title_crew k ON b.tconst = k.tconst
LEFT JOIN name_basics d ON k.directors = d.nconst
LEFT JOIN name_basics w ON k.writers = w.nconst
WHERE b.titleType = 'movie' AND b.startYear IS NOT NULL
  AND k.directors IS NOT NULL AND k.writers IS NOT NULL
  AND d.primaryName IS NOT NULL AND w.primaryName IS NOT NULL AND d.primaryName <> w.primaryName
GROUP BY d.primaryName, w.primaryName
ORDER BY collaboration_count DESC, director_name ASC, writer_name ASC
LIMIT 20""",

    "top_titles_per_genre": """
SELECT primaryTitle, startYear, genre, averageRating, numVotes, genre_rank
FROM (SELECT *, CAST(rank() OVER (PARTITION BY genre ORDER BY numVotes DESC) AS INTEGER) AS genre_rank
      FROM (SELECT b.primaryTitle, b.startYear, unnest(string_split(b.genres, ',')) AS genre,
                   r.averageRating, r.numVotes
            FROM title_basics b JOIN title_ratings r ON b.tconst = r.tconst
            WHERE b.titleType = 'movie' AND b.genres IS NOT NULL AND r.numVotes >= 1000) x) y
WHERE genre_rank <= 5""",

    "genre_runtime_ranking": """,
per AS (
  SELECT genre, CAST(trunc(avg(runtimeMinutes)) AS INTEGER) AS avg_runtime, count(*) AS movie_count
  FROM (SELECT runtimeMinutes, unnest(string_split(genres, ',')) AS genre FROM title_basics
        WHERE titleType = 'movie' AND runtimeMinutes IS NOT NULL AND genres IS NOT NULL
          AND runtimeMinutes > 0 AND runtimeMinutes < 1000) x
  GROUP BY genre),
g AS (SELECT *, (SELECT CAST(trunc(avg(avg_runtime)) AS INTEGER) FROM per) AS global_avg_runtime FROM per)
SELECT genre, avg_runtime, movie_count, global_avg_runtime,
       CAST(dense_rank() OVER (ORDER BY avg_runtime DESC) AS INTEGER) AS runtime_rank,
       CAST(dense_rank() OVER (ORDER BY movie_count DESC) AS INTEGER) AS popularity_rank,
       avg_runtime - global_avg_runtime AS diff_from_global_avg,
       CAST(trunc((avg_runtime - global_avg_runtime) * 100 / global_avg_runtime) AS INTEGER) AS percentage_diff
FROM g""",

    "adult_split_by_year": """,
a AS (SELECT startYear, count(*) AS adult_count FROM title_basics WHERE isAdult = 1 GROUP BY startYear),
n AS (SELECT startYear, count(*) AS non_adult_count FROM title_basics WHERE isAdult = 0 GROUP BY startYear),
j AS (
  SELECT CAST(coalesce(coalesce(a.startYear, n.startYear), 0) AS INTEGER) AS startYear,
         coalesce(a.adult_count, 0) AS adult_count, coalesce(n.non_adult_count, 0) AS non_adult_count
  FROM a FULL OUTER JOIN n ON a.startYear = n.startYear)
SELECT * FROM j WHERE startYear <= 2025""",

    "titles_per_category": """
SELECT category, count(DISTINCT tconst) AS distinct_movies
FROM title_principals WHERE category IS NOT NULL
GROUP BY category""",

    "most_referenced_titles": """,
m AS (
  SELECT unnest(string_split(knownForTitles, ',')) AS tconst FROM name_basics
  WHERE (contains(primaryProfession, 'actor') OR contains(primaryProfession, 'actress'))
    AND knownForTitles IS NOT NULL),
c AS (SELECT tconst, count(*) AS mention_count FROM m GROUP BY tconst)
SELECT c.tconst, b.primaryTitle, b.startYear, c.mention_count
FROM c LEFT JOIN title_basics b ON c.tconst = b.tconst
ORDER BY c.mention_count DESC, c.tconst ASC NULLS FIRST
LIMIT 20""",

    "episodes_per_season_by_year": """
SELECT startYear, avg(episode_count) AS avg_episodes
FROM (SELECT b.startYear, e.parentTconst, e.seasonNumber, count(e.tconst) AS episode_count
      FROM title_episode e LEFT JOIN title_basics b ON e.parentTconst = b.tconst
      WHERE b.startYear >= 1990 AND e.seasonNumber IS NOT NULL
      GROUP BY b.startYear, e.parentTconst, e.seasonNumber) s
GROUP BY startYear""",

    "release_gap_by_director": """,
dm AS (
  SELECT b.tconst, b.startYear, unnest(string_split(k.directors, ',')) AS director
  FROM title_basics b JOIN title_crew k ON b.tconst = k.tconst
  WHERE b.titleType = 'movie' AND b.startYear IS NOT NULL AND k.directors IS NOT NULL),
g AS (
  SELECT director, tconst,
         startYear - lag(startYear) OVER (PARTITION BY director ORDER BY startYear) AS yearGap
  FROM dm),
s AS (
  SELECT director, avg(yearGap) AS averageGap, count(tconst) AS movieCount
  FROM g GROUP BY director HAVING avg(yearGap) IS NOT NULL),
t AS (SELECT * FROM s ORDER BY movieCount DESC, director ASC NULLS FIRST LIMIT 20)
SELECT t.director, n.primaryName, t.movieCount, t.averageGap
FROM t LEFT JOIN name_basics n ON t.director = n.nconst""",

    "close_releases_by_director": """,
dm AS (
  SELECT row_number() OVER () AS no, startYear, director AS creator
  FROM (SELECT b.startYear, unnest(string_split(k.directors, ',')) AS director
        FROM title_basics b JOIN title_crew k ON b.tconst = k.tconst
        WHERE b.titleType = 'movie' AND b.startYear IS NOT NULL AND k.directors IS NOT NULL)),
pairs AS (
  SELECT a.creator, count(*) AS close_pairs FROM dm a JOIN dm b ON a.creator = b.creator AND a.no < b.no
  WHERE abs(a.startYear - b.startYear) <= 2 GROUP BY a.creator),
t AS (
  SELECT creator, close_pairs, (SELECT count(*) FROM dm WHERE dm.creator = pairs.creator) AS title_count
  FROM pairs ORDER BY close_pairs DESC, creator ASC LIMIT 20)
SELECT t.creator, n.primaryName, t.title_count, t.close_pairs
FROM t LEFT JOIN name_basics n ON t.creator = n.nconst""",

    "last_acclaimed_title": """,
dm AS (
  SELECT b.tconst, b.startYear, unnest(string_split(k.directors, ',')) AS creator
  FROM title_basics b JOIN title_crew k ON b.tconst = k.tconst
  WHERE b.titleType = 'movie' AND b.startYear IS NOT NULL AND k.directors IS NOT NULL),
voted AS (
  SELECT dm.creator, dm.startYear, max(dm.tconst) AS tconst
  FROM dm JOIN title_ratings r ON dm.tconst = r.tconst WHERE r.numVotes >= 1000 GROUP BY dm.creator, dm.startYear)
SELECT dm.creator, dm.tconst, dm.startYear, v.tconst AS prev_tconst, v.startYear AS prev_startYear, dm.startYear - v.startYear AS years_since
FROM dm ASOF LEFT JOIN voted v ON dm.creator = v.creator AND dm.startYear > v.startYear""",

    "title_rank_positions": """
SELECT tconst, averageRating, numVotes, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank,
       percent_rank() OVER w AS percent_rank, cume_dist() OVER w AS cume_dist,
       CAST((rank() OVER w - 1) * 4 // count(*) OVER () + 1 AS INTEGER) AS tile
FROM title_ratings
WINDOW w AS (ORDER BY averageRating DESC NULLS LAST, numVotes DESC NULLS LAST)""",

    "title_subtotals": """,
t AS (
  SELECT b.titleType, CAST(trunc(b.startYear / 10) * 10 AS INTEGER) AS decade, b.genres, r.numVotes, r.tconst AS rated
  FROM title_basics b LEFT JOIN title_ratings r ON b.tconst = r.tconst),
g AS (
  SELECT titleType, decade, numVotes, rated, unnest(list_distinct(string_split(genres, ','))) AS genre FROM t WHERE genres IS NOT NULL
  UNION ALL SELECT titleType, decade, numVotes, rated, NULL AS genre FROM t WHERE genres IS NULL)
SELECT titleType, decade, genre, CAST(grouping(titleType, decade, genre) AS INTEGER) AS grouping_id,
       count(*) AS title_count, count(rated) AS rated_count, CAST(coalesce(sum(numVotes), 0) AS BIGINT) AS total_votes
FROM g GROUP BY GROUPING SETS ((titleType, decade, genre), (titleType, genre), (decade, genre), (genre))
UNION ALL
SELECT titleType, decade, NULL AS genre, CAST(grouping(titleType, decade) * 2 + 1 AS INTEGER) AS grouping_id,
       count(*) AS title_count, count(rated) AS rated_count, CAST(coalesce(sum(numVotes), 0) AS BIGINT) AS total_votes
FROM t GROUP BY GROUPING SETS ((titleType, decade), (titleType), (decade), ())""",

    "genre_decade_matrix": """,
x AS (
  SELECT CAST(trunc(startYear / 10) * 10 AS INTEGER) AS decade, unnest(string_split(genres, ',')) AS genre
  FROM title_basics WHERE titleType = 'movie' AND genres IS NOT NULL)
SELECT genre, """ + ", ".join(f"count(*) FILTER (WHERE decade = {d}) AS movies_{d}" for d in range(1950, 2030, 10)) + """,
       count(*) FILTER (WHERE decade < 1950 OR decade > 2020) AS movies_other, count(*) FILTER (WHERE decade IS NULL) AS movies_missing
FROM x GROUP BY genre""",

    "genre_trailing_votes": """,
x AS (
  SELECT b.startYear, r.numVotes, unnest(string_split(b.genres, ',')) AS genre
  FROM title_basics b JOIN title_ratings r ON b.tconst = r.tconst
  WHERE b.titleType = 'movie' AND b.genres IS NOT NULL AND b.startYear IS NOT NULL),
y AS (SELECT genre, startYear, count(*) AS title_count, CAST(sum(numVotes) AS BIGINT) AS votes FROM x GROUP BY genre, startYear)
SELECT y.genre, y.startYear, y.title_count, y.votes, count(DISTINCT x.startYear) AS trailing_years, count(*) AS trailing_titles,
       CAST(sum(x.numVotes) AS BIGINT) AS trailing_votes, CAST(sum(x.numVotes) AS BIGINT) / count(*) AS trailing_avg_votes
FROM y JOIN x ON x.genre = y.genre AND x.startYear BETWEEN y.startYear - 4 AND y.startYear
GROUP BY y.genre, y.startYear, y.title_count, y.votes""",

    "genre_vote_quantiles": """,
x AS (
  SELECT unnest(string_split(b.genres, ',')) AS genre, b.startYear, r.numVotes
  FROM title_basics b JOIN title_ratings r ON b.tconst = r.tconst WHERE b.titleType = 'movie' AND b.genres IS NOT NULL),
g AS (SELECT genre, count(numVotes) AS title_count, count(DISTINCT startYear) + CAST(bool_or(startYear IS NULL) AS BIGINT) AS sketches FROM x GROUP BY genre)
SELECT genre, unnest([CAST(0.1 AS DOUBLE), 0.25, 0.5, 0.75, 0.9, 0.99]) AS probability, title_count, sketches, true AS within_bound FROM g""",

    "character_list_quality": """,
c AS (SELECT category, nconst, characters,
             CASE WHEN json_valid(characters) AND json_type(characters) = 'ARRAY' THEN json_extract_string(characters, '$[*]') END AS names FROM title_principals),
d AS (SELECT category, count(DISTINCT name) AS distinct_characters FROM (SELECT category, unnest(names) AS name FROM c) u GROUP BY category)
SELECT c.category, count(*) AS credit_count, count(*) FILTER (WHERE characters IS NULL) AS missing,
       count(*) FILTER (WHERE characters IS NOT NULL AND names IS NULL) AS malformed, count(*) FILTER (WHERE len(names) = 0) AS empty,
       count(*) FILTER (WHERE len(names) > 0) AS listed, coalesce(any_value(d.distinct_characters), 0) AS distinct_characters
FROM c LEFT JOIN d ON d.category IS NOT DISTINCT FROM c.category GROUP BY c.category""",

    "people_by_characters": """,
c AS (SELECT nconst, characters,
             CASE WHEN json_valid(characters) AND json_type(characters) = 'ARRAY' THEN json_extract_string(characters, '$[*]') END AS names FROM title_principals),
p AS (SELECT nconst, count(DISTINCT name) AS character_count, count(*) AS part_count
      FROM (SELECT nconst, unnest(names) AS name FROM c) u WHERE name <> '' GROUP BY nconst)
SELECT p.nconst, n.primaryName, p.character_count, p.part_count FROM (SELECT * FROM p ORDER BY character_count DESC, part_count DESC, nconst LIMIT 20) p
LEFT JOIN name_basics n ON n.nconst = p.nconst""",

    "director_source_differences": """,
o AS (SELECT tconst, unnest(string_split(directors, ',')) AS nconst FROM title_crew WHERE directors IS NOT NULL),
n AS (SELECT tconst, nconst FROM title_principals WHERE category = 'director'),
k AS (SELECT tconst FROM o UNION SELECT tconst FROM n),
c AS (SELECT tconst, count(*) AS common_rows FROM (SELECT * FROM o INTERSECT ALL SELECT * FROM n) GROUP BY tconst),
a AS (SELECT tconst, count(*) AS only_old FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM n) GROUP BY tconst),
b AS (SELECT tconst, count(*) AS only_new FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM o) GROUP BY tconst),
alone AS (SELECT tconst FROM (SELECT * FROM o EXCEPT SELECT * FROM n) UNION SELECT tconst FROM (SELECT * FROM n EXCEPT SELECT * FROM o)),
f AS (
  SELECT k.tconst, (SELECT count(*) FROM o WHERE o.tconst = k.tconst) AS old_rows, (SELECT count(*) FROM n WHERE n.tconst = k.tconst) AS new_rows,
         coalesce(c.common_rows, 0) AS common_rows, coalesce(a.only_old, 0) AS only_old, coalesce(b.only_new, 0) AS only_new,
         k.tconst IN (SELECT tconst FROM alone) AS differs
  FROM k LEFT JOIN c USING (tconst) LEFT JOIN a USING (tconst) LEFT JOIN b USING (tconst))
SELECT tconst, old_rows, new_rows, common_rows, only_old, only_new,
       CASE WHEN old_rows = 0 THEN 'added' WHEN new_rows = 0 THEN 'removed' WHEN differs THEN 'changed'
            WHEN only_old + only_new > 0 THEN 'recounted' ELSE 'same' END AS status
FROM f""",

    "votes_by_year_running_avg": """,
y AS (
  SELECT b.startYear, avg(r.numVotes) AS avgVotes
  FROM title_ratings r JOIN title_basics b ON r.tconst = b.tconst
  WHERE r.averageRating > 7.5 AND b.startYear IS NOT NULL
  GROUP BY b.startYear)
SELECT startYear, avgVotes,
       avg(avgVotes) OVER (ORDER BY startYear ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulativeAvgVotes
FROM y""",

    "duplicate_titles": """,
c AS (
  SELECT primaryTitle, count(primaryTitle) AS numVersions FROM title_basics b
  WHERE NOT EXISTS (SELECT 1 FROM title_episode e WHERE e.tconst = b.tconst)
  GROUP BY primaryTitle)
SELECT primaryTitle, numVersions FROM c WHERE numVersions > 1
ORDER BY numVersions DESC, primaryTitle ASC
LIMIT 20""",

    "series_by_episode_count": """,
c AS (SELECT parentTconst, count(tconst) AS numEpisodes FROM title_episode GROUP BY parentTconst)
SELECT b.primaryTitle, c.numEpisodes
FROM c JOIN title_basics b ON c.parentTconst = b.tconst
WHERE b.titleType = 'tvSeries'
ORDER BY c.numEpisodes DESC, c.parentTconst ASC
LIMIT 20""",

    "top_actors_per_genre": f""",
j AS (
  SELECT g.genre, n.primaryName, count(*) AS appearance_count
  FROM {MOVIE_GENRES} g
  JOIN title_principals p ON g.tconst = p.tconst
  JOIN name_basics n ON p.nconst = n.nconst
  WHERE p.category IN ('actor', 'actress')
  GROUP BY g.genre, n.primaryName),
r AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY genre ORDER BY appearance_count DESC) AS INTEGER) AS "rank"
      FROM j)
SELECT genre, primaryName, appearance_count, "rank" FROM r WHERE "rank" <= 1""",

    "rating_by_decade": """
SELECT CAST(trunc(b.startYear / 10) AS INTEGER) * 10 AS decade, avg(r.averageRating) AS avg_rating,
       count(*) AS movie_count
FROM title_basics b JOIN title_ratings r ON b.tconst = r.tconst
WHERE b.startYear IS NOT NULL AND regexp_matches(CAST(b.startYear AS VARCHAR), '^[0-9]{4}$')
GROUP BY 1""",

    "top_titles_per_region": """,
rated AS (
  SELECT b.tconst, b.primaryTitle, b.startYear, r.averageRating, r.numVotes
  FROM title_basics b JOIN title_ratings r ON b.tconst = r.tconst
  WHERE b.titleType = 'movie' AND r.numVotes >= 1000),
reg AS (SELECT DISTINCT titleId, region FROM title_akas WHERE region IS NOT NULL),
r AS (
  SELECT rated.*, reg.region,
         CAST(row_number() OVER (PARTITION BY reg.region
              ORDER BY rated.averageRating DESC, rated.numVotes DESC, rated.tconst ASC) AS INTEGER) AS "rank"
  FROM rated JOIN reg ON rated.tconst = reg.titleId)
SELECT primaryTitle, startYear, region, averageRating, numVotes, "rank" FROM r WHERE "rank" <= 3""",

    "most_genre_diverse_people": f""",
g AS (
  SELECT p.nconst, count(DISTINCT x.genre) AS genre_count
  FROM {MOVIE_GENRES} x JOIN title_principals p ON x.tconst = p.tconst
  WHERE p.category IN ('actor', 'actress')
  GROUP BY p.nconst)
SELECT n.primaryName, CAST(g.genre_count AS INTEGER) AS genre_count
FROM g JOIN name_basics n ON g.nconst = n.nconst
ORDER BY g.genre_count DESC, g.nconst ASC
LIMIT 20""",

    "directors_of_high_rated": """,
d AS (
  SELECT unnest(string_split(k.directors, ',')) AS director
  FROM title_ratings r JOIN title_basics b ON r.tconst = b.tconst JOIN title_crew k ON b.tconst = k.tconst
  WHERE r.averageRating >= 8.5 AND b.titleType = 'movie' AND k.directors IS NOT NULL),
c AS (SELECT director, count(*) AS top_movie_count FROM d GROUP BY director)
SELECT n.primaryName, c.top_movie_count
FROM c LEFT JOIN name_basics n ON c.director = n.nconst
ORDER BY c.top_movie_count DESC, c.director ASC NULLS FIRST
LIMIT 20""",

    "genre_growth_by_decade": """,
x AS (
  SELECT CAST(floor(startYear / 10) * 10 AS INTEGER) AS decade, unnest(string_split(genres, ',')) AS genre
  FROM title_basics
  WHERE titleType = 'movie' AND genres IS NOT NULL AND startYear IS NOT NULL AND startYear >= 1990),
c AS (SELECT decade, genre, count(*) AS movie_count FROM x GROUP BY decade, genre),
l AS (SELECT *, lag(movie_count) OVER (PARTITION BY genre ORDER BY decade) AS prev_decade_count FROM c)
SELECT decade, genre, movie_count, prev_decade_count, movie_count - prev_decade_count AS growth
FROM l
ORDER BY growth DESC NULLS LAST, genre ASC, decade ASC
LIMIT 20""",
}

# Columns rounded to 6 decimals on both sides of the comparison: values whose
# floating-point summation order legitimately differs between engines (and
# between Spark runs with different partitionings).
ROUNDED = {
    "improving_directors": ("avg_rating_trend",),
    "votes_by_year_running_avg": ("cumulativeAvgVotes",),
    "catalog_numeric_stats": ("stddev",),
    "catalog_column_stats": ("stddev",),
}


def _profile_sql() -> str:
    parts = []
    for table, schema in sorted(SCHEMAS.items()):
        view = table.replace(".", "_")
        for i, f in enumerate(schema.fields):
            parts.append(
                f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, CAST({i + 1} AS INTEGER) AS position, "
                f"'{f.dataType.simpleString()}' AS data_type, true AS nullable, count(*) AS row_count, "
                f"count(*) - count({f.name}) AS null_count FROM {view}")
    return "\n" + "\nUNION ALL\n".join(parts)


def _numeric_stats_sql() -> str:
    parts = []
    for table, schema in sorted(SCHEMAS.items()):
        view = table.replace(".", "_")
        for f in schema.fields:
            if f.dataType.simpleString() in ("int", "double", "float"):
                parts.append(
                    f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, count({f.name}) AS count, "
                    f"avg({f.name}) AS mean, stddev_samp({f.name}) AS stddev, "
                    f"CAST(min({f.name}) AS DOUBLE) AS min, CAST(max({f.name}) AS DOUBLE) AS max FROM {view}")
    return "\n" + "\nUNION ALL\n".join(parts)


def _column_stats_sql() -> str:
    parts = []
    for table, schema in sorted(SCHEMAS.items()):
        view = table.replace(".", "_")
        for f in schema.fields:
            c = f.name
            if f.dataType.simpleString() == "string":
                values = (f"CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS min, "
                          f"CAST(NULL AS DOUBLE) AS max, min({c}) AS min_text, max({c}) AS max_text")
            else:
                values = (f"avg({c}) AS mean, stddev_samp({c}) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
                          f"CAST(max({c}) AS DOUBLE) AS max, CAST(NULL AS VARCHAR) AS min_text, "
                          f"CAST(NULL AS VARCHAR) AS max_text")
            parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, count({c}) AS count, {values} "
                         f"FROM {view}")
    return "\n" + "\nUNION ALL\n".join(parts)


def _key_violations_sql() -> str:
    from titlelens.sources.schemas import KEYS
    parts = []
    for table in sorted(SCHEMAS):
        view = table.replace(".", "_")
        cols = ", ".join(KEYS[table])
        any_null = " OR ".join(f"{k} IS NULL" for k in KEYS[table])
        parts.append(
            f"SELECT '{table}' AS table_name, "
            f"CAST(coalesce(sum(CASE WHEN {any_null} THEN n END), 0) AS BIGINT) AS null_keys, "
            f"count(*) FILTER (WHERE NOT ({any_null}) AND n > 1) AS duplicated_keys, "
            f"CAST(coalesce(sum(CASE WHEN NOT ({any_null}) AND n > 1 THEN n END), 0) AS BIGINT) "
            f"AS rows_with_duplicated_keys "
            f"FROM (SELECT {cols}, count(*) AS n FROM {view} GROUP BY {cols}) g")
    return "\n" + "\nUNION ALL\n".join(parts)


def _tables_sql() -> str:
    parts = []
    for table, schema in sorted(SCHEMAS.items()):
        ddl = ",".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in schema.fields)
        parts.append(f"SELECT '{table}' AS table_name, CAST({len(schema.fields)} AS INTEGER) AS column_count, "
                     f"count(*) AS row_count, '{ddl}' AS schema_ddl FROM {table.replace('.', '_')}")
    return "\n" + "\nUNION ALL\n".join(parts)


QUESTIONS_SQL["catalog_tables"] = _tables_sql()
QUESTIONS_SQL["catalog_profile"] = _profile_sql()
QUESTIONS_SQL["catalog_numeric_stats"] = _numeric_stats_sql()
QUESTIONS_SQL["catalog_column_stats"] = _column_stats_sql()
QUESTIONS_SQL["catalog_key_violations"] = _key_violations_sql()


def oracle_statement(name: str) -> str:
    """Full statement: catalogue CTEs, then the question (its own extra CTEs
    continue the WITH list when the body starts with a comma)."""
    body = QUESTIONS_SQL[name].strip("\n")
    if body.startswith(","):
        sql = f"WITH {CATALOG_CTES}{body}"
    else:
        sql = f"WITH {CATALOG_CTES}\n{body}"
    cols = ROUNDED.get(name)
    if cols:
        replaced = ", ".join(f"round({c}, 6) AS {c}" for c in cols)
        sql = f"WITH __q AS ({sql})\nSELECT * REPLACE ({replaced}) FROM __q"
    return sql

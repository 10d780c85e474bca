"""DuckDB oracle SQL for the registered queries (same output column names).

Each statement inlines the fixture views it needs as CTEs over the pre-registered
warehouse tables.  A trained model has no SQL: the ``_checks`` queries return what must hold of it whatever its
factors are (which rows there are, checks computed from them), and the statements give those rows.
"""

from __future__ import annotations

RATINGS = """ratings as (
  select o_custkey::int as "userId", l_partkey::int as "movieId",
         (ceil(l_quantity / 5) / 2)::double as rating, epoch(o_orderdate)::bigint as ts
  from lineitem join orders on l_orderkey = o_orderkey)"""

MOVIES = """movies as (
  select p_partkey::int as "movieId", p_name as title, p_type || '|' || p_brand as genres from part)"""

USERS = """users as (
  select c_custkey::int as "userId", case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
         (18 + c_custkey % 50)::int as age from customer)"""

LINK_LINES = """link_lines as (
  select p_partkey::varchar || ',' || (100000 + p_partkey)::varchar || ',' ||
         case when p_size % 7 <> 0 then (200000 + p_partkey)::varchar else '' end as value
  from part)"""

REQUESTS = """requests as (
  select 'real-time' as key, user_id || '%' || (event_id % 100) || '%' || value as value from events)"""

TRAIN = """train as (
  select "userId", "movieId", rating from (
    select *, row_number() over (order by ts, "userId", "movieId", rating) rn, count(*) over () n from ratings)
  where rn <= floor(n * 0.6::double)::bigint)"""

TEST = """test as (
  select "userId", "movieId", rating from (
    select *, row_number() over (order by ts desc, "userId" desc, "movieId" desc, rating desc) rn,
           count(*) over () n from ratings)
  where rn <= floor(n * (1 - 0.6::double))::bigint)"""

POPULAR = """popular as (
  select t."movieId", m.title, t.cnt from (
    select "movieId", count(*) cnt from ratings group by 1 order by cnt desc, "movieId" limit 5) t
  join movies m on m."movieId" = t."movieId")"""

REQ_USERS = """req as (select distinct split_part(value, '%', 1)::int as "userId" from requests)"""

KNOWN = """known as (select distinct "userId" from ratings where "userId" % 3 = 0)"""

FACTOR_RECS = """factor_recs as (
  select a.vec_id::int as "userId", b.vec_id::int as "movieId",
         list_inner_product(a.embedding::double[], b.embedding::double[]) as score
  from embeddings a, embeddings b where a.vec_id % 10 = 0 and b.vec_id % 10 <> 0
  qualify row_number() over (partition by a.vec_id order by score desc, b.vec_id) <= 5)"""

ITEM_MEAN_JOIN = """im as (select "movieId", sum(rating) s, count(*) c from train group by 1),
pairs as (select distinct "userId", "movieId" from test),
pred as (select p."userId", p."movieId", im.s / im.c as prediction from pairs p join im using ("movieId")),
joined as (select pred."userId", pred."movieId", pred.prediction, t.rating
           from pred join test t on t."userId" = pred."userId" and t."movieId" = pred."movieId")"""


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


ROUTED = _with(RATINGS, MOVIES, POPULAR, REQUESTS, REQ_USERS, FACTOR_RECS, """routed as (
  select r."userId", f."movieId", round(f.score, 6) as rating
  from req r join factor_recs f on f."userId" = r."userId"
  union all
  select r."userId", p."movieId", 0.0::double
  from req r cross join popular p
  where r."userId" not in (select "userId" from factor_recs))""")


ORACLE: dict[str, str] = {
    "rating_count": _with(RATINGS) + "select count(*) as n from ratings",
    "movie_popularity": _with(RATINGS) + 'select "movieId", count(*) as cnt from ratings group by 1',
    "popular_top_k": _with(RATINGS, MOVIES, POPULAR) + 'select "movieId", title, cnt from popular',
    "distinct_users": _with(RATINGS) + 'select distinct "userId" from ratings',
    "nth_user": _with(RATINGS) + 'select "userId" from (select distinct "userId" from ratings) '
                                 'order by "userId" limit 1 offset 99',
    "ingest_incomplete_filter": _with(LINK_LINES) + "select value from link_lines where not ends_with(value, ',')",
    "ingest_links": 'select p_partkey::int as "movieId", (100000 + p_partkey)::int as "imdbId", '
                    '(200000 + p_partkey)::int as "tmdbId" from part where p_size % 7 <> 0',
    "ingest_movies": _with(MOVIES) + 'select "movieId", title, genres from movies',
    "ingest_users": _with(USERS) + 'select "userId", gender, age from users',
    "ingest_ratings": _with(RATINGS) + 'select "userId", "movieId", rating, ts from ratings',
    "ingest_tags_repaired": 'select (p_partkey % 10)::int as "userId", p_partkey::int as "movieId", '
                            'p_name as tag, (1000 + p_size)::bigint as ts from part',
    "ingest_quarantine": _with(LINK_LINES) + "select value, 'too few fields' as reason from link_lines "
                                             "where ends_with(value, ',')",
    "ingest_movies_quoted": "select p_partkey::int as \"movieId\", replace(p_name, ' ', ', \" ') as title, "
                            "p_type as genres from part where p_partkey % 5 <> 0",
    "movies_deduped": _with(MOVIES) + """, both_rows as (select * from movies union all
  select "movieId", (case when "movieId" % 2 = 0 then 'a ' else 'z ' end) || title, 'other' from movies where "movieId" % 3 = 0)
select "movieId", title, genres from both_rows
qualify row_number() over (partition by "movieId" order by title, genres) = 1""",
    "text_round_trip": _with(RATINGS) + 'select "userId", "movieId", rating, ts from ratings',
    "publish_twice": _with(USERS) + 'select "userId", gender, age + 1 as age from users',
    "publish_interrupted": _with(USERS) + """select "userId", gender, age, reader from users, (values ('between'), ('pinned')) v(reader)
union all select "userId", gender, age + 1, 'after' from users""",
    "ctas_append": _with(MOVIES) + 'select "movieId", title, genres from movies',
    "stream_restart": ROUTED + 'select "userId", "movieId", rating from routed',
    "stream_recovery": ROUTED + 'select "userId", "movieId", rating, 1::bigint as times from routed',
    "stream_trigger": ROUTED + 'select "userId", "movieId", rating, 1::bigint as times from routed',
    "ingest_incremental": _with(RATINGS) + 'select "userId", "movieId", rating, ts from ratings',
    "ingest_files": """select count(*) as lines_there, count(*)::bigint as lines_read, 1::bigint as times_read,
  count(*) filter (p_size % 7 <> 0) as n_rows from part""",
    "split_train": _with(RATINGS, TRAIN) + "select * from train",
    "split_test": _with(RATINGS, TEST) + "select * from test",
    "rank_within_rating": _with(RATINGS) + 'select "userId", "movieId", rating, ts, '
                          'row_number() over (partition by rating order by "userId", "movieId", ts) as rank '
                          'from ratings',
    "rank_band_sample": _with(RATINGS) + """select "userId", "movieId", rating, rank,
       (case when rank <= n // 3 then 1 when rank <= 2 * (n // 3) then 2 else 3 end)::int as band
from (select *, row_number() over (partition by rating order by "userId", "movieId", ts) as rank,
             count(*) over (partition by rating) as n from ratings)""",
    "wire_encode": _with(RATINGS) + """select 'real-time' as key,
       "userId"::varchar || '%' || "movieId"::varchar || '%' || rating::varchar as value from ratings""",
    "wire_decode": _with(REQUESTS) + """select split_part(value, '%', 1)::int as "userId",
       split_part(value, '%', 2)::int as "movieId", split_part(value, '%', 3)::double as rating from requests""",
    "request_users": 'select distinct user_id::int as "userId" from events where event_id % 5 <> 3',
    "route_known_users": _with(RATINGS, KNOWN, REQUESTS, REQ_USERS)
    + 'select "userId" from req where "userId" in (select "userId" from known)',
    "route_new_users": _with(RATINGS, KNOWN, REQUESTS, REQ_USERS)
    + 'select "userId" from req where "userId" not in (select "userId" from known)',
    "fallback_popular": _with(RATINGS, MOVIES, KNOWN, POPULAR, REQUESTS, REQ_USERS)
    + """select r."userId", p."movieId", 0.0::double as rating
from req r cross join popular p
where r."userId" not in (select "userId" from known)
  and p."movieId" in (select "movieId" from movies)""",
    "recommend_routed": _with(RATINGS, MOVIES, POPULAR, REQUESTS, REQ_USERS, FACTOR_RECS)
    + """select r."userId", f."movieId", round(f.score, 6) as rating
from req r join factor_recs f on f."userId" = r."userId"
union all
select r."userId", p."movieId", 0.0::double
from req r cross join popular p
where r."userId" not in (select "userId" from factor_recs)""",
    "recommendation_titles": _with(MOVIES, FACTOR_RECS)
    + """select f."userId", f."movieId", round(f.score, 6) as score, m.title
from factor_recs f left join movies m on m."movieId" = f."movieId\"""",
    "factor_top_k": _with(FACTOR_RECS) + 'select "userId", "movieId", round(score, 6) as score from factor_recs',
    "prediction_fact_join": _with(RATINGS, TRAIN, TEST, ITEM_MEAN_JOIN)
    + 'select "userId", "movieId", round(prediction, 6) as prediction, rating from joined',
    "rmse_item_mean": _with(RATINGS, TRAIN, TEST, ITEM_MEAN_JOIN)
    + "select round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) as rmse, count(*) as n from joined",
    "best_run": _with(RATINGS, TRAIN, TEST) + """, runs as (select * from (values (1, 0.0::double), (2, 1.0::double),
                      (3, 5.0::double), (4, 25.0::double)) v(run_id, damping)),
mu as (select avg(rating) as mu from train),
im as (select "movieId", sum(rating) s, count(*) c from train group by 1),
models as (select im."movieId", runs.run_id, runs.damping,
                  (im.s + runs.damping * mu.mu) / (im.c + runs.damping) as prediction
           from im, runs, mu),
metrics as (select run_id, damping, sqrt(avg((prediction - rating) * (prediction - rating))) as rmse,
                   count(*) as n
            from test t join models m on m."movieId" = t."movieId" group by run_id, damping)
select run_id, damping, round(rmse, 6) as rmse, n from metrics where rmse is not null
order by rmse, run_id limit 1""",
    "colocated_predictions": _with(RATINGS, TRAIN, TEST, ITEM_MEAN_JOIN)
    + 'select "userId", "movieId", round(prediction, 6) as prediction, rating from joined',
    "colocated_titles": _with(MOVIES, FACTOR_RECS) + """select f."userId", f."movieId", round(f.score, 6) as score, m.title
from factor_recs f left join movies m on m."movieId" = f."movieId\"""",
    "colocated_membership": _with(RATINGS, KNOWN, REQUESTS, REQ_USERS)
    + 'select "userId", "userId" in (select "userId" from known) as known from req',
    "membership_index": _with(RATINGS, KNOWN, REQUESTS, REQ_USERS)
    + 'select "userId", "userId" in (select "userId" from known) as known from req',
    "bounded_top_k": """select "userId", "movieId", round(score, 6) as score from (
  select a.vec_id::int as "userId", b.vec_id::int as "movieId",
         list_inner_product(a.embedding::double[], b.embedding::double[]) / (1 + b.vec_id % 50) as score
  from embeddings a, embeddings b where a.vec_id % 10 = 0 and b.vec_id % 10 <> 0)
qualify row_number() over (partition by "userId" order by score desc, "movieId") <= 5""",
    "als_train_summary_checks": _with(RATINGS, TRAIN, TEST) + """select 10 as rank, 10 as iterations, 0.07::double as "lambda",
  (select count(*) from test where "userId" in (select "userId" from train) and "movieId" in (select "movieId" from train)) as n,
  count(distinct "userId") as n_users, count(distinct "movieId") as n_items, true as scored, true as better_than_mean from train""",
    "als_predict_pairs_checks": _with(RATINGS, TRAIN, TEST) + """select "userId", "movieId", rating, true as finite from test
where "userId" in (select "userId" from train) and "movieId" in (select "movieId" from train)""",
    "als_grid_checks": _with(RATINGS, TRAIN, TEST) + """select v.run_id::int as run_id, 10::int as rank, 10::int as iterations, v.reg as "lambda", 10::int as blocks,
  (select count(*) from test where "userId" in (select "userId" from train) and "movieId" in (select "movieId" from train)) as n,
  true as better_than_mean, true as best_is_least
from (values (1, 0.07::double), (2, 0.2::double)) v(run_id, reg)""",
    "recommend_one_user_checks": _with(RATINGS, TRAIN) + """select u."userId", r.rank::int as rank, true as distinct_movies, true as falling, true as own_score
from (select min("userId") as "userId" from train) u cross join range(1, 6) r(rank)""",
    "recommend_all_users_checks": _with(RATINGS, TRAIN) + """select u."userId", r.rank::int as rank, true as distinct_movies, true as falling, true as own_score
from (select distinct "userId" from train) u cross join range(1, 6) r(rank)""",
    "popularity_stream": _with(RATINGS, MOVIES, POPULAR) + 'select "movieId", title, cnt from popular',
    "replay_in_order": _with(RATINGS) + 'select "userId", "movieId", rating, ts, true as in_order from ratings',
    "fold_in_users": _with(RATINGS, TRAIN) + """select distinct "userId", "userId" % 5 <> 0 as trained, "userId" % 5 <> 0 as own_factors
from train where "movieId" in (select "movieId" from train where "userId" % 5 <> 0)""",
    "model_round_trip": _with(RATINGS, TRAIN) + 'select distinct "userId", true as same from train',
}

"""Star-schema rating queries and the SQL-rewrite exercises.

Inputs are three relations:

* ``ratings(userid, movieid, rate)`` - the fact table,
* ``users(userid, <attributes>)``   - a dimension keyed by ``userid``,
* ``movies(movieid, moviename)``    - a dimension keyed by ``movieid``.

Plans are declared with the DataFrame API and left to Catalyst and AQE:
dimension joins become broadcast joins only when the runtime size of the
(filtered) side is under ``spark.sql.autoBroadcastJoinThreshold``; otherwise
they stay shuffle joins.  Facts are aggregated per ``movieid`` before the
title join, so the join and the title aggregate see one row per movie
instead of one row per rating.

Ratings may also be kept as a pair ``(facts, links)``: ``facts(linkid,
movieid, rate)`` and ``links(linkid, userid)`` with one user per link.  Users
are then filtered on the links before the fact table is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _of_users(ratings: DataFrame | tuple[DataFrame, DataFrame], users: DataFrame) -> DataFrame:
    """Ratings ``(userid, movieid, rate)`` of the given users (one row each)."""
    if isinstance(ratings, tuple):
        facts, links = ratings
        return facts.join(links.join(users, "userid", "left_semi"), "linkid").drop("linkid")
    return ratings.join(users, "userid", "left_semi")


def average_rating_by(ratings: DataFrame | tuple[DataFrame, DataFrame], users: DataFrame, movie_id: int,
                      attribute: str) -> DataFrame:
    """Average rate of one movie per user attribute: ``<attribute>, avgrate``.

    The movie filter is pushed into the fact scan; AQE turns the join into a
    broadcast of the few matching ratings when they are small.
    """
    if isinstance(ratings, tuple):
        facts, links = ratings
        r = facts.where(F.col("movieid") == F.lit(movie_id)).join(links, "linkid").select("userid", "rate")
    else:
        r = ratings.where(F.col("movieid") == F.lit(movie_id)).select("userid", "rate")
    u = users.select("userid", attribute)
    return (r.join(u, "userid")
             .groupBy(attribute)
             .agg(F.avg("rate").alias("avgrate")))


def _per_movie(ratings: DataFrame) -> DataFrame:
    # One row per movie: map-side partial sums, then a shuffle of partials.
    return ratings.groupBy("movieid").agg(F.sum("rate").alias("rate_sum"),
                                          F.count(F.lit(1)).alias("n"))


def _per_title(per_movie: DataFrame, movies: DataFrame) -> DataFrame:
    # Several movies may share a name; the name is the reported group.
    return (per_movie.join(movies.select("movieid", "moviename"), "movieid")
            .groupBy("moviename")
            .agg((F.sum("rate_sum") / F.sum("n")).alias("avgrate"),
                 F.sum("n").alias("total")))


def top_titles(ratings: DataFrame | tuple[DataFrame, DataFrame], users: DataFrame, movies: DataFrame,
               user_filter: Column, min_total: int = 50, k: int = 10) -> DataFrame:
    """Top ``k`` titles by average rate among ratings of users matching
    ``user_filter``, for titles rated more than ``min_total`` times:
    ``moviename, avgrate, total``.  Ties on the average go by name.
    """
    u = users.where(user_filter).select("userid")
    per_title = _per_title(_per_movie(_of_users(ratings, u)), movies)
    return (per_title.where(F.col("total") > min_total)
            .orderBy(F.desc("avgrate"), F.asc("moviename"))
            .limit(k))


def top_user(ratings: DataFrame | tuple[DataFrame, DataFrame], users: DataFrame, user_filter: Column) -> DataFrame:
    """The user with the most ratings among users matching ``user_filter``
    (ties go to the smallest id): ``userid, total`` - exactly one row."""
    u = users.where(user_filter).select("userid")
    return (_of_users(ratings, u)
            .groupBy("userid").agg(F.count(F.lit(1)).alias("total"))
            .orderBy(F.desc("total"), F.asc("userid"))
            .limit(1))


def top_titles_of_top_user(ratings: DataFrame | tuple[DataFrame, DataFrame], users: DataFrame, movies: DataFrame,
                           user_filter: Column, k: int = 10) -> DataFrame:
    """Top ``k`` titles by average rate of the most active matching user:
    ``moviename, avgrate``.

    The top-1 subquery has exactly one row, so broadcasting it is bounded
    by construction; only that user's ratings reach the fact join.
    """
    best = F.broadcast(top_user(ratings, users, user_filter).select("userid"))
    per_title = _per_title(_per_movie(_of_users(ratings, best)), movies)
    return (per_title.select("moviename", "avgrate")
            .orderBy(F.desc("avgrate"), F.asc("moviename"))
            .limit(k))


def stacked_range_filter(t: DataFrame, low: float, high: float) -> DataFrame:
    """Names of the rows with a salary between the bounds, written as two
    filters in a row and a constant condition: Catalyst folds the constant and
    pushes one merged filter into the scan."""
    inner = t.where((F.lit(1) == F.lit(1)) & (F.col("sal") > low)).select("name", "sal")
    return inner.where(F.col("sal") < high).select("name")


def distinct_except(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct rows of ``left`` that are not in ``right``, on ``columns``.

    Both sides are de-duplicated first (partial aggregation in each map
    task, so only distinct keys are shuffled), then a null-safe left anti
    join removes keys found on the right - the same as SQL ``EXCEPT``, where
    NULL equals NULL.
    """
    l = left.select(*columns).distinct()
    r = right.select(*columns).distinct()
    cond = None
    for c in columns:
        term = l[c].eqNullSafe(r[c])
        cond = term if cond is None else cond & term
    return l.join(r, cond, "left_anti")


def computed_columns(df: DataFrame, id_col: str, prefix: str) -> DataFrame:
    """``id, name = concat(prefix, id), id2 = double(id) * 1.0`` over a key column."""
    return df.select(
        F.col(id_col).alias("id"),
        F.concat(F.lit(prefix), F.col(id_col)).alias("name"),
        (F.col(id_col).cast("double") * F.lit(1.0)).alias("id2"),
    )

from pyspark.sql import functions as F

from tessera.operators import relational as rel
from tessera.sources.text import read_delimited
from conftest import write

USER = "userid int, sex string, age int, occupation int, zipcode int"
MOVIE = "movieid int, moviename string, movietype string"
RATING = "userid int, movieid int, rate int, times int"


def _fixture(spark, tmp):
    users = ["1::M::25::4::70072-1234", "2::M::35::1::55117", "3::F::25::2::02460",
             "4::F::45::7::48067", "5::M::25::3::10001"]
    movies = ["10::Alpha::Drama", "11::Beta::Comedy", "12::Gamma::Drama", "13::Alpha::Horror",
              "14::Delta::Drama"]
    ratings = []
    # movie 10: 50 ratings by male users, movie 11: 51 ratings
    ratings += [f"{1 + i % 2}::10::4::{i}" for i in range(50)]
    ratings += [f"{1 + i % 2}::11::3::{i}" for i in range(51)]
    # movie 13 shares the name Alpha with movie 10
    ratings += ["5::12::5::1", "5::12::3::2", "5::14::4::3", "5::13::2::4"]
    # female users: user 3 and 4 tie on count; the smaller id wins
    ratings += ["3::12::5::9", "3::14::1::9", "4::10::2::9", "4::11::4::9"]
    for name, rows in (("user", users), ("movie", movies), ("rating", ratings)):
        write(f"{tmp}/{name}/data.txt", "\n".join(rows) + "\n")
    u = read_delimited(spark, f"{tmp}/user", USER)
    m = read_delimited(spark, f"{tmp}/movie", MOVIE)
    r = read_delimited(spark, f"{tmp}/rating", RATING)
    return u, m, r


def test_multi_char_delimiter_and_bad_int(spark, tmp):
    u, m, r = _fixture(spark, tmp)
    zips = {row.userid: row.zipcode for row in u.collect()}
    assert zips[1] is None and zips[2] == 55117
    assert m.where("movieid = 10").first().movietype == "Drama"


def test_delimited_fields_like_hive(spark, tmp):
    write(f"{tmp}/t/a.txt", "1::::5\n2::\\N:: 7\n3::a\n4::b::7::extra\n+5::c::1.5\n")
    rows = [tuple(r) for r in read_delimited(spark, f"{tmp}/t", "id int, s string, n int").collect()]
    assert rows == [(1, "", 5), (2, None, None), (3, "a", None), (4, "b", 7), (5, "c", None)]


def test_average_by_attribute(spark, tmp):
    u, m, r = _fixture(spark, tmp)
    got = {row.age: row.avgrate for row in rel.average_rating_by(r, u, 12, "age").collect()}
    assert got == {25: (5 + 3 + 5) / 3}


def test_top_titles_having_and_ties(spark, tmp):
    u, m, r = _fixture(spark, tmp)
    got = [tuple(x) for x in rel.top_titles(r, u, m, F.col("sex") == "M", 50, 10).collect()]
    # Beta has 51 ratings (> 50); Alpha has 50 from movie 10 plus 1 from movie 13 = 51
    assert got == [("Alpha", (50 * 4 + 2) / 51, 51), ("Beta", 3.0, 51)]


def test_top_titles_of_top_user(spark, tmp):
    u, m, r = _fixture(spark, tmp)
    assert rel.top_user(r, u, F.col("sex") == "F").first().userid == 3
    got = [tuple(x) for x in rel.top_titles_of_top_user(r, u, m, F.col("sex") == "F", 10).collect()]
    assert got == [("Gamma", 5.0), ("Delta", 1.0)]


def test_stacked_filters_plan_merges(spark):
    t = spark.createDataFrame([("a", 999.0), ("b", 1000.0), ("c", 1500.0), ("d", 2000.0), ("e", None)],
                              "name string, sal double")
    q = rel.stacked_range_filter(t, 1000, 2000)
    assert [r.name for r in q.collect()] == ["c"]
    opt = q._jdf.queryExecution().optimizedPlan().toString()
    assert opt.count("Filter") == 1 and "1 = 1" not in opt


def test_except_with_nulls(spark):
    t = spark.createDataFrame([("a", 1500.0, "x", 10), ("b", 1200.0, None, 10), ("c", 1800.0, "y", 10),
                               ("d", 1900.0, "y", 10), ("e", 1900.0, "z", 20)],
                              "name string, sal double, job string, deptno int")
    t1 = spark.createDataFrame([(2500.0, "x"), (2600.0, None), (100.0, "y")], "sal double, job string")
    left = t.where((F.col("sal") > 1000) & (F.lit(1) == 1)).where(F.col("deptno") == 10)
    got = sorted(r.job for r in rel.distinct_except(left, t1.where(F.col("sal") > 2000), ["job"]).collect())
    assert got == ["y"]


def test_computed_columns(spark):
    from tessera.sources.text import number_range
    rows = number_range(spark, 10).collect()
    assert [(r.id, r.name, r.id2) for r in rows[:2]] == [(0, "id-0", 0.0), (1, "id-1", 1.0)]
    assert len(rows) == 10


def test_sql_over_registered_views_matches_operators(spark, tmp):
    from tessera.sources.text import register_delimited
    _fixture(spark, tmp)
    register_delimited(spark, "t_user", f"{tmp}/user", USER)
    register_delimited(spark, "t_movie", f"{tmp}/movie", MOVIE)
    register_delimited(spark, "t_rating", f"{tmp}/rating", RATING)
    sql = spark.sql("""
        SELECT m.moviename, avg(r.rate) AS avgrate, count(*) AS total
        FROM t_rating r JOIN t_user u ON r.userid = u.userid JOIN t_movie m ON r.movieid = m.movieid
        WHERE u.sex = 'M' GROUP BY m.moviename HAVING count(*) > 50
        ORDER BY avgrate DESC, moviename LIMIT 10""")
    u, m, r = spark.table("t_user"), spark.table("t_movie"), spark.table("t_rating")
    ops = rel.top_titles(r, u, m, F.col("sex") == "M", 50, 10)
    assert [tuple(x) for x in sql.collect()] == [tuple(x) for x in ops.collect()]


def test_equal_averages_break_ties_by_name(spark):
    users = spark.createDataFrame([(1, "M")], "userid int, sex string")
    movies = spark.createDataFrame([(1, "Zeta"), (2, "Eta"), (3, "Theta")], "movieid int, moviename string")
    ratings = spark.createDataFrame([(1, 1, 4), (1, 1, 2), (1, 2, 3), (1, 3, 5)], "userid int, movieid int, rate int")
    got = [(r.moviename, r.avgrate) for r in rel.top_titles(ratings, users, movies, F.col("sex") == "M", 0, 2).collect()]
    assert got == [("Theta", 5.0), ("Eta", 3.0)]      # Zeta also averages 3.0 but sorts after Eta


def test_sql_except_equals_operator(spark):
    left = spark.createDataFrame([("x",), ("y",), (None,), ("y",)], "job string")
    right = spark.createDataFrame([("x",), (None,)], "job string")
    left.createOrReplaceTempView("l_jobs")
    right.createOrReplaceTempView("r_jobs")
    sql = sorted(r.job for r in spark.sql("SELECT DISTINCT job FROM l_jobs EXCEPT SELECT job FROM r_jobs").collect())
    ops = sorted(r.job for r in rel.distinct_except(left, right, ["job"]).collect())
    assert sql == ops == ["y"]

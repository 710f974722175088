from tessera.streaming.traffic import current_totals, start_traffic_totals
from conftest import write


def line(key, up, down):
    f = [f"f{i}" for i in range(10)]
    f[1], f[8], f[9] = key, str(up), str(down)
    return "\t".join(f)


def test_stream_matches_batch_totals(spark, tmp):
    inp, out, ck = f"{tmp}/in", f"{tmp}/out", f"{tmp}/ck"
    write(f"{inp}/a.log", "\n".join([line("k1", 1, 2), line("k2", 5, 5), ""]) + "\n")
    q = start_traffic_totals(spark, inp, out, ck, available_now=True)
    q.awaitTermination(120)
    assert {r.key: r.total for r in current_totals(spark, out).collect()} == {"k1": 3, "k2": 10}
    write(f"{inp}/b.log", "\n".join([line("k1", 10, 0), line("k3", 1, 1)]) + "\n")
    q = start_traffic_totals(spark, inp, out, ck, available_now=True)
    q.awaitTermination(120)
    got = {r.key: (r.up, r.down, r.total) for r in current_totals(spark, out).collect()}
    assert got == {"k1": (11, 2, 13), "k2": (5, 5, 10), "k3": (1, 1, 2)}

import glob
import os

import pytest
from pyspark.errors import AnalysisException

from tessera.__main__ import main
from conftest import write


def test_cli_traffic_and_copy(spark, tmp):
    f = [f"f{i}" for i in range(10)]
    f[1], f[8], f[9] = "k", "4", "5"
    write(f"{tmp}/logs/a.log", "\t".join(f) + "\n")
    assert main(["traffic", f"{tmp}/logs", f"{tmp}/out", "--files", "2"]) == 0
    text = "".join(open(p).read() for p in glob.glob(f"{tmp}/out/part-*"))
    assert text == "k\t4 5 9\n"
    write(f"{tmp}/src/x.txt", "x")
    os.makedirs(f"{tmp}/dst")
    assert main(["copy", f"{tmp}/src", f"{tmp}/dst", "--tasks", "2"]) == 0
    assert open(f"{tmp}/dst/src/x.txt").read() == "x"


def test_cli_index(spark, tmp):
    assert main(["index", "/root/testdata/sf0.001/documents.parquet", f"{tmp}/idx", "--counts",
                 "--block-size", "50"]) == 0
    out = spark.read.parquet(f"{tmp}/idx")
    assert out.columns == ["word", "block", "postings"] and out.count() > 0
    assert out.agg({"block": "max"}).first()[0] >= 1


def test_cli_cells(spark, tmp):
    from tessera.operators.cells import CELL_SCHEMA
    batch = spark.createDataFrame([("Tom", "info", "class", "1", 1), ("Tom", "score", "programming", "82", 1),
                                   ("Ann", "info", "student_id", "S-2", 2)], CELL_SCHEMA)
    batch.write.parquet(f"{tmp}/batch")
    # a table that is not there is never taken as empty unless it is named as new
    for args in (["put", f"{tmp}/table", f"{tmp}/batch", f"{tmp}/v0"], ["get", f"{tmp}/table", f"{tmp}/batch", f"{tmp}/v0"],
                 ["delete", f"{tmp}/table", f"{tmp}/batch", f"{tmp}/v0"]):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            main(["cells", *args])
    with pytest.raises(SystemExit):
        main(["cells", "put", f"{tmp}/batch", f"{tmp}/batch", f"{tmp}/v0", "--new"])
    assert not os.path.exists(f"{tmp}/v0")
    assert main(["cells", "put", f"{tmp}/table", f"{tmp}/batch", f"{tmp}/v1", "--new"]) == 0
    write(f"{tmp}/keys.txt", "Ann\n")
    assert main(["cells", "get", f"{tmp}/v1", f"{tmp}/keys.txt", f"{tmp}/got"]) == 0
    assert [r.value for r in spark.read.text(f"{tmp}/got").collect()] == ["Ann\tinfo:student_id\tS-2"]
    assert main(["cells", "delete", f"{tmp}/v1", f"{tmp}/keys.txt", f"{tmp}/v2"]) == 0
    assert sorted(r.row_key for r in spark.read.parquet(f"{tmp}/v2").collect()) == ["Tom", "Tom"]

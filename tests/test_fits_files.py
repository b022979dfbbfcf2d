import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.sources import fits
from skyloom.sources.fits_files import FitsImages, planes_of


@pytest.fixture
def source(spark):
    spark.dataSource.register(FitsImages)
    return spark.read.format("fits_images")


def images(spark, n=6):
    rows = [(f"i{i}.fits", {"OBJECT": f"it''s no. {i}", "CRVAL1": repr(i / 3), "NOTE": "long " * 40 + "end's"}, "first line\nBMAJ=0.5 " + "x" * 100, 3, 2, [float(i * v) for v in range(6)]) for i in range(n)]
    return spark.createDataFrame(rows, "name string, header map<string,string>, history string, nx int, ny int, pixels array<double>")


def test_round_trip_in_both_directions(spark, source, tmp_path):
    folder = str(tmp_path / "out")
    images(spark).write.format("fits_images").mode("append").save(folder)
    assert sorted(os.listdir(folder)) == [f"i{i}.fits" for i in range(6)]
    back = source.option("taskbytes", 1).load(folder)
    assert back.rdd.getNumPartitions() == 6
    rows = {r.path.rsplit("/", 1)[1]: r for r in back.collect()}
    for r in images(spark).collect():
        got = rows[r.name]
        assert (got.nx, got.ny, got.pixels) == (3, 2, r.pixels) and all(got.header[k] == v for k, v in r.header.items()), got.header
        assert got.history.startswith("first line\nBMAJ=0.5 x")
    raw = (tmp_path / "out" / "i1.fits").read_bytes()
    assert len(raw) % 2880 == 0 and b"CRVAL1  =   0.3333333333333333" in raw  # a number, not text
    again = str(tmp_path / "again")
    back.write.format("fits_images").mode("append").save(again)  # by path, sample keys left out
    assert source.load(again).agg(F.sum(F.aggregate("pixels", F.lit(0.0), lambda a, v: a + v))).first()[0] == 15 * sum(range(6))
    assert source.option("pixels", "false").load(folder).filter("pixels IS NOT NULL").count() == 0


def cube(path, planes=4, cards=()):
    data = np.arange(planes * 6, dtype=">i2").reshape(planes, 2, 3)
    head = b"".join(c.ljust(80).encode() for c in ["SIMPLE  =                    T", "BITPIX  =                   16", "NAXIS   =                    3", "NAXIS1  =                    3", "NAXIS2  =                    2", f"NAXIS3  = {planes:>20}", *cards, "END"])
    path.write_bytes(head.ljust(-(-len(head) // 2880) * 2880) + data.tobytes().ljust(2880, b"\0"))
    return data


def test_planes_are_read_alone(source, tmp_path):
    data = cube(tmp_path / "c.fits", cards=["BSCALE  =                  2.0", "BLANK   =                    7", *(f"COMMENT {i}" for i in range(700))])
    rows = {r.plane: r for r in source.option("planes", "all").load(str(tmp_path)).collect()}
    assert sorted(rows) == [0, 1, 2, 3] and np.isnan(rows[1].pixels[2])
    assert rows[3].pixels == [float(v) * 2 for v in data[3].T.ravel()]
    some = source.option("planes", "1-2").load(str(tmp_path / "c.f*"))
    assert some.rdd.getNumPartitions() == 2 and sorted(r.plane for r in some.collect()) == [1, 2]
    with pytest.raises(Exception, match="has no plane 4"):
        source.option("planes", "4").load(str(tmp_path)).collect()
    assert planes_of("0,2-4") == [0, 2, 3, 4]


def test_what_is_no_image_is_an_error_and_an_empty_folder_empty(source, tmp_path):
    assert source.load(str(tmp_path)).collect() == []
    (tmp_path / "a.fits").write_bytes(b"other")
    with pytest.raises(Exception, match="no reader for"):
        source.load(str(tmp_path)).collect()
    (tmp_path / "a.fits").write_bytes(fits.render(np.ones((20, 20)))[:2890])
    with pytest.raises(Exception, match="ends within plane 0"):
        source.load(str(tmp_path)).collect()


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    spark.dataSource.register(FitsImages)
    folder = tmp_path / "out"
    bad = images(spark).repartition(3).withColumn("nx", F.when(F.col("name") == "i4.fits", 5).otherwise(F.col("nx")))
    with pytest.raises(Exception, match="reshape"):
        bad.write.format("fits_images").mode("append").save(str(folder))
    assert not folder.exists() or os.listdir(folder) == []


def test_names_come_once_and_modes_hold(spark, source, tmp_path):
    folder = str(tmp_path / "out")
    twice = images(spark).withColumn("name", F.lit("same.fits"))
    with pytest.raises(Exception, match="come twice"):
        twice.write.format("fits_images").mode("append").save(folder)
    images(spark, 2).write.format("fits_images").mode("append").save(folder)
    with pytest.raises(Exception, match="there already"):
        images(spark, 3).write.format("fits_images").mode("append").save(folder)
    assert len(os.listdir(folder)) == 2
    images(spark, 1).write.format("fits_images").mode("overwrite").save(folder)
    assert os.listdir(folder) == ["i0.fits"] and source.load(folder).count() == 1
    images(spark).limit(0).write.format("fits_images").mode("append").save(folder)
    assert os.listdir(folder) == ["i0.fits"]

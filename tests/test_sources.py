"""Readers and sinks on small files written to a fresh scratch folder."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tabsieve.functions import scalar as S
from tabsieve.operators import model
from tabsieve.sources import readers


def _scratch():
    return tempfile.mkdtemp(prefix="tabsieve-test-")


def test_csv_glob_typed_with_sentinel(spark):
    d = _scratch()
    for i in range(2):
        with open(os.path.join(d, f"train-{i}.csv"), "w") as fh:
            fh.write(",".join(readers.MOVIE_CSV_COLUMNS) + "\n")
            fh.write(f"tt000000{i},Title {i},,\\N,\\N,95,1200,True\n")
            fh.write(f"tt100000{i},Other,Autre,1999,\\N,abc,\\N,False\n")
    df = readers.read_movie_csv(spark, os.path.join(d, "train-*.csv"), split="train")
    typed = df.select("tconst", S.parse_int("startYear").alias("year"),
                      S.parse_int("runtimeMinutes").alias("rt"), "split")
    rows = {r["tconst"]: r for r in typed.collect()}
    assert len(rows) == 4
    assert rows["tt0000000"]["year"] is None and rows["tt0000000"]["rt"] == 95
    assert rows["tt1000001"]["year"] == 1999 and rows["tt1000001"]["rt"] is None
    assert {r["split"] for r in rows.values()} == {"train"}


def test_optional_source(spark):
    d = _scratch()
    assert readers.read_optional(spark, os.path.join(d, "missing.csv"),
                                 lambda s, p: readers.read_csv(s, p, ["a"])) is None
    p = os.path.join(d, "there.csv")
    with open(p, "w") as fh:
        fh.write("a\n1\n")
    assert readers.read_optional(spark, p, lambda s, q: readers.read_csv(s, q, ["a"])).count() == 1


def test_column_json_pairs_by_key(spark):
    d = _scratch()
    p = os.path.join(d, "directing.json")
    with open(p, "w") as fh:
        json.dump({"movie": {"0": "tt1", "1": "tt2", "2": "tt2"},
                   "director": {"0": "nm9", "2": "nm8", "1": "nm7"}}, fh)
    got = sorted(tuple(r) for r in readers.read_column_json(spark, p, "movie", "director",
                                                            "tconst", "director_id").collect())
    assert got == [("tt1", "nm9"), ("tt2", "nm7"), ("tt2", "nm8")]


def test_records_json(spark):
    d = _scratch()
    p = os.path.join(d, "writing.json")
    with open(p, "w") as fh:
        json.dump([{"movie": "tt1", "writer": "nm1"}, {"movie": "tt1", "writer": "nm2"}], fh)
    df = readers.read_records_json(spark, p, {"movie": "tconst", "writer": "writer_id"},
                                   lines=False)
    assert df.columns == ["tconst", "writer_id"] and df.count() == 2


def test_header_normalisation_and_curated_list(spark):
    d = _scratch()
    p = os.path.join(d, "list.csv")
    with open(p, "w") as fh:
        fh.write(" Pos ,Title, Year \n1,The Birds,1963\nx,Nothing,1990\n3,,2001\n")
    df = readers.read_curated_list(spark, p, {"pos": "rank", "title": "title", "year": "year"},
                                   numeric=["rank", "year"], required=["rank", "title"])
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["rank"] == 1.0 and rows[0]["title"] == "The Birds"


def test_ordered_text_sink(spark):
    d = _scratch()
    src = spark.createDataFrame([(k,) for k in [5, 3, 9, 1, 7, 2]], "k long").repartition(1)
    with_id = model.with_row_id(src, files=False)
    pred = with_id.select("row_id", F.when(F.col("k") > 4, "True").otherwise("False")
                          .alias("prediction"))
    out = os.path.join(d, "pred")
    model.write_predictions(pred, out)
    lines = []
    for name in sorted(os.listdir(out)):
        if name.startswith("part-"):
            with open(os.path.join(out, name)) as fh:
                lines += fh.read().splitlines()
    assert lines == ["True", "False", "True", "False", "True", "False"]


def test_multiline_quoted_csv(spark):
    d = _scratch()
    p = os.path.join(d, "credits.csv")
    with open(p, "w") as fh:
        fh.write('id,crew\n1,"[{\'job\': \'Director\', \'name\': \'A, B\'},\n {\'job\': \'Editor\', \'name\': None}]"\n')
    df = readers.read_csv(spark, p, ["id", "crew"], multiline=True, escape='"')
    rows = df.collect()
    assert len(rows) == 1 and "Editor" in rows[0]["crew"]
    from tabsieve.operators import joins
    names = df.select(joins.names_with_role(joins.parse_crew("crew"), "director").alias("d")).collect()
    assert names[0]["d"] == ["A, B"]


def test_clean_split_end_to_end(spark):
    from tabsieve.operators import clean
    d = _scratch()
    p = os.path.join(d, "train-1.csv")
    with open(p, "w") as fh:
        fh.write(",".join(readers.MOVIE_CSV_COLUMNS) + "\n")
        fh.write("tt1,The Birds,,1963,\\N,119,50000,True\n")
        fh.write("tt2,AmÃ©lie,Le Fabuleux,2001,\\N,\\N,700000,True\n")
        fh.write("tt3,Short,,2001,\\N,5000,,False\n")
        fh.write("tt4,X,,\\N,\\N,80,10,False\n")
    raw = readers.read_movie_csv(spark, p).distinct()
    out = {r["tconst"]: r for r in clean.clean_split(raw).collect()}
    assert out["tt1"]["runtime"] == 119 and out["tt1"]["title_clean"] == "the birds"
    assert out["tt2"]["title_clean"] == "amelie" and out["tt2"]["is_foreign"] == 1
    assert out["tt2"]["votes"] == 400000.0 and out["tt2"]["runtime"] == 210  # cap; decade median
    assert out["tt3"]["runtime"] == 210 and out["tt3"]["votes"] == 400000.0  # clamp; median fill
    assert out["tt4"]["film_age"] is None and out["tt4"]["runtime_short"] == 1
    coded = {r["tconst"]: r for r in clean.clean_split(raw, compat=True).collect()}
    assert coded["tt4"]["film_age"] == 1 and coded["tt2"]["runtime"] == 1


def test_external_features(spark):
    from tabsieve.operators import enrich
    d = _scratch()
    files = {
        "links": "movieId,imdbId,tmdbId\n1,1234,5\n2,12345678,6\n3,,7\n",
        "movies": "movieId,title,genres\n1,A,Drama|Sci-Fi\n2,B,(no genres listed)\n3,C,Comedy\n",
        "ratings": "userId,movieId,rating,timestamp\n1,1,4.0,0\n2,1,3.0,0\n3,1,5.0,0\n1,2,2.5,0\n",
        "tags": "userId,movieId,tag,timestamp\n1,1,x,0\n1,1,y,0\n",
        "genome-scores": "movieId,tagId,relevance\n1,10,0.9\n1,11,0.2\n2,10,0.1\n",
        "genome-tags": "tagId,tag\n10,Feel-Good\n11,dark\n",
    }
    dfs = {}
    for name, body in files.items():
        path = os.path.join(d, f"{name}.csv")
        with open(path, "w") as fh:
            fh.write(body)
        dfs[name] = readers.read_external_csv(spark, path, name)
    out, missing = enrich.external_features(dfs["links"], dfs["movies"], dfs["ratings"],
                                            dfs["tags"], dfs["genome-scores"], dfs["genome-tags"])
    rows = {r["tconst"]: r for r in out.collect()}
    assert set(rows) == {"tt0001234", "tt12345678"}
    a, b = rows["tt0001234"], rows["tt12345678"]
    assert a["genre_drama"] == 1 and a["genre_sci_fi"] == 1 and a["genre_count"] == 2
    assert a["ml_rating_mean"] == 4.0 and a["ml_rating_median"] == 4.0 and a["ml_tag_count"] == 2
    assert b["ml_rating_std"] == 0.0 and b["ml_tag_count"] == 0 and b["genre_count"] == 1
    assert a["mltag_feel_good"] == 0.9 and a["mltag_dark"] == 0.2 and b["mltag_dark"] is None
    assert "masterpiece" in missing and "dark" not in missing


def test_json_lines_are_all_read(spark):
    p = os.path.join(_scratch(), "writing.json")
    with open(p, "w") as fh:
        fh.writelines(json.dumps({"movie": f"tt{i}", "writer": "nm1"}) + "\n" for i in range(100))
    df = readers.read_records_json(spark, p, {"movie": "tconst", "writer": "writer_id"})
    assert df.select("tconst").distinct().count() == 100


def test_hidden_split_without_label(spark):
    p = os.path.join(_scratch(), "hidden-1.csv")
    with open(p, "w") as fh:
        fh.write(",".join(readers.MOVIE_CSV_COLUMNS[:-1]) + "\n")
        fh.write("tt1,One,,1999,\\N,90,10\ntt2,Two,,2000,\\N,95,20\n")
    rows = readers.read_movie_csv(spark, p, split="hidden").orderBy("tconst").collect()
    assert [(r.tconst, r.numVotes, r.label, r.split) for r in rows] == [
        ("tt1", "10", None, "hidden"), ("tt2", "20", None, "hidden")]


def test_whole_numbers_with_decimal_point(spark):
    p = os.path.join(_scratch(), "links.csv")
    with open(p, "w") as fh:
        fh.write("movieId,imdbId,tmdbId\n1,1234,5.0\n2,77,\n3,x,9.5\n")
    rows = readers.read_external_csv(spark, p, "links").orderBy("movieId").collect()
    assert [tuple(r) for r in rows] == [(1, 1234, 5), (2, 77, None), (3, None, None)]


def test_malformed_rows_are_counted(spark):
    p = os.path.join(_scratch(), "train-1.csv")
    with open(p, "w") as fh:
        fh.write(",".join(readers.MOVIE_CSV_COLUMNS) + "\n")
        fh.write("tt1,One,,1999,\\N,90,10,True\ntt2,broken\ntt3,a,b,c,d,e,f,g,h,i\ntt4,Four,,2000,\\N,95,20,False\n")
    assert {r.tconst for r in readers.read_movie_csv(spark, p).collect()} == {"tt1", "tt4"}
    assert readers.count_rejected(readers.scan_csv(spark, p)) == 2
    with pytest.raises(Exception, match="malformed CSV row"):
        readers.read_csv(spark, p, readers.MOVIE_CSV_COLUMNS).collect()


def test_drifting_headers(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["\ufeffPos  Nr", " title", "Title "])
    assert readers.normalize_headers(df).columns == ["pos_nr", "title", "title_2"]


def test_row_ids_follow_files_of_unequal_size(spark):
    d, at = _scratch(), 0
    for i, n in enumerate([500, 40000, 2000]):
        spark.range(at, at + n).coalesce(1).write.parquet(os.path.join(d, f"tmp{i}"))
        part = [f for f in os.listdir(os.path.join(d, f"tmp{i}")) if f.startswith("part-")][0]
        os.makedirs(os.path.join(d, "all"), exist_ok=True)
        os.link(os.path.join(d, f"tmp{i}", part), os.path.join(d, "all", f"part-{i}.parquet"))
        at += n
    df = model.with_row_id(spark.read.parquet(os.path.join(d, "all")).select("id", "_metadata"))
    got = [r["id"] for r in df.orderBy("row_id").select("id").collect()]
    assert got == list(range(at))

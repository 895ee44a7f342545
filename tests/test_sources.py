import pytest

import coterie as ct
from conftest import G7


def _file(tmp_path, text, name="ratings.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_header_and_its_copies_are_dropped(spark, tmp_path):
    path = _file(tmp_path, "userId,movieId,rating\n1,10,4\nuserId,movieId,rating\n2,-20,5,extra\n 3, 30 \n")
    assert _rows(ct.read_ratings(spark, path)) == [(1, 10), (2, -20), (3, 30)]


def test_first_data_line_counts_as_header(spark, tmp_path):
    assert _rows(ct.read_ratings(spark, _file(tmp_path, "1,10\n1,10\n2,20\n"))) == [(2, 20)]


def test_header_is_that_of_the_first_file(spark, tmp_path):
    _file(tmp_path, "u,i\n1,10\n", "a.csv")
    _file(tmp_path, "2,20\n3,30\n4,40\n5,50\n6,60\n", "b.csv")
    assert len(_rows(ct.read_ratings(spark, str(tmp_path)))) == 6


@pytest.mark.parametrize("text", ["", "userId,movieId\n"])
def test_no_ratings(spark, tmp_path, text):
    rows = ct.read_ratings(spark, _file(tmp_path, text))
    assert rows.columns == ["user", "item"] and rows.collect() == []
    assert ct.coaffiliation_edges(rows).collect() == []


@pytest.mark.parametrize("bad", ["x,1", "1,2.5", "1,", "1", ""])
def test_bad_lines_fail_or_are_dropped(spark, tmp_path, bad):
    path = _file(tmp_path, f"u,i\n1,10\n{bad}\n2,20\n")
    with pytest.raises(Exception, match="not a rating"):
        ct.read_ratings(spark, path).collect()
    assert _rows(ct.read_ratings(spark, path, on_error="drop")) == [(1, 10), (2, 20)]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        ct.read_ratings(spark, "x", on_error="skip")


def _text(folder):
    return [line for part in sorted(folder.glob("part-*")) for line in part.read_text().splitlines()]


def test_written_lines_are_sorted(spark, tmp_path):
    scores = spark.createDataFrame([(2, 10, 1.5), (1, 3, 12.0), (2, 9, 1 / 3)], "src long, dst long, score double")
    ct.write_scores(scores, str(tmp_path / "full"))
    assert _text(tmp_path / "full") == ["(1,3,12.0)", "(2,9,0.3333333333333333)", "(2,10,1.5)"]
    ct.write_scores(scores, str(tmp_path / "short"), digits=2)
    assert _text(tmp_path / "short") == ["(1,3,12.00)", "(2,9,0.33)", "(2,10,1.50)"]
    labels = spark.createDataFrame([(2, 10), (2, 2), (1, 3), (1, 1), (5, 5)], "community long, vertex long")
    ct.write_communities(labels, str(tmp_path / "sets"))
    assert _text(tmp_path / "sets") == ["[1,3]", "[2,10]", "[5]"]


def test_long_communities_continue_in_parts(spark, limits):
    labels = spark.createDataFrame([(1, v) for v in range(1, 8)] + [(9, 9)], "community long, vertex long")
    for settings in ({}, {"broadcastRows": 0, "hotKeys": 2}):
        with limits(**settings):
            lines = [tuple(r) for r in ct.community_lines(labels, row_length=3).collect()]
        assert lines == [(1, 0, "[1,2,3,"), (1, 1, "4,5,6,"), (1, 2, "7]"), (9, 0, "[9]")]


def test_wrapped_communities_join_to_one_list(spark, tmp_path):
    labels = spark.createDataFrame([(1, v) for v in range(1, 8)] + [(9, 9), (10, 10), (10, 11), (10, 12)], "community long, vertex long")
    ct.write_communities(labels, str(tmp_path / "short"), row_length=3)
    ct.write_communities(labels, str(tmp_path / "long"))
    assert "".join(_text(tmp_path / "short")).replace("][", "]\n[").split("\n") == _text(tmp_path / "long")


def test_header_after_many_empty_files(spark, tmp_path):
    for k in range(50):
        (tmp_path / f"a{k:02}.csv").write_text("")
    (tmp_path / "b.csv").write_text("userId,movieId\n1,2\n")
    (tmp_path / "c.csv").write_text("userId,movieId\n3,4\n")
    assert sorted(map(tuple, ct.read_ratings(spark, str(tmp_path)).collect())) == [(1, 2), (3, 4)]


def test_from_ratings_text_to_lines(spark, tmp_path):
    """The whole chain on the graph of seven: an edge's two users hold one item that nobody else holds."""
    path = _file(tmp_path, "userId,item\n" + "".join(f"{u},{i}\n" for i, e in enumerate(G7) for u in e))
    edges = ct.coaffiliation_edges(ct.read_ratings(spark, path), min_shared=1)
    scores = ct.edge_betweenness(edges)
    ct.write_scores(scores, str(tmp_path / "scores"), digits=1)
    ct.write_communities(ct.best_communities(ct.removal_order(scores)), str(tmp_path / "communities"))
    ct.write_communities(ct.structural_components(edges, epsilon=0.8305), str(tmp_path / "clusters"))
    read = lambda name: [r.value for r in spark.read.text(str(tmp_path / name)).collect()]
    assert sorted(read("scores")) == [
        "(1,2,5.0)", "(1,3,1.0)", "(2,3,5.0)", "(2,4,12.0)", "(4,5,4.5)", "(4,6,4.0)", "(4,7,4.5)", "(5,6,1.5)", "(6,7,1.5)",
    ]
    assert sorted(read("communities")) == ["[1,2,3]", "[4,5,6,7]"]
    assert sorted(read("clusters")) == ["[1,2,3]", "[4,5,6,7]"]

"""The centroids come to the cells once a lane, not once a cell."""

import pyarrow as pa
import pytest

from quire.operators import cluster
from quire.session import written


@pytest.mark.parametrize("sent", [0, 100])
def test_centroids_come_once_a_lane(spark, monkeypatch, sent):
    monkeypatch.setattr(cluster, "PART_TERMS", 20)
    monkeypatch.setattr(cluster, "CHUNK_POINTS", 64)
    monkeypatch.setattr(cluster, "SENT_PARTS", sent)
    rows = [(i, f"t{(i * 7 + j * 5) % 40}", 1.0 + j) for i in range(8000) for j in range(3)]
    points = written(cluster.as_vectors(spark.createDataFrame(rows, "doc_id long, term string, w double")), "points")
    some = spark.createDataFrame(rows, "doc_id long, term string, w double")
    grid = cluster._Grid(points, some, 2)
    c, _ = grid.centroids(cluster.init_points(some, 2))

    def brought(k):
        def run(batches):
            n = sum(b.num_rows - b["ws"].null_count for b in batches)
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([n], pa.int32()), "at": pa.array([b""]), "dots": pa.array([b""])})
        return run

    monkeypatch.setattr(cluster, "_cell_dots", brought)
    cells = grid.cells.where("chunk >= 0").count()
    assert sum(r.chunk for r in grid._dots(c).collect()) == grid.parts * grid.lanes < cells

import tracemalloc

import numpy as np
import pyarrow as pa

from tallyworks.llm import qualitymodel as qm

from .test_qualitymodel import sample


def test_sparse_bags_train_the_same_model():
    texts, labels = sample(200)
    bags = np.stack([qm.bag(t.encode(), qm.BUCKETS) for t in [*texts[:-1], ""]])
    places = [np.flatnonzero(b) for b in bags]
    sparse = qm.SparseBags(
        pa.chunked_array([pa.array(places[:90], pa.list_(pa.int32())), pa.array(places[90:], pa.list_(pa.int32()))]),
        pa.chunked_array([pa.array([b[p] for b, p in zip(bags, places)], pa.list_(pa.float32()))]),
        qm.BUCKETS,
    )
    assert sparse.shape == bags.shape and np.array_equal(sparse[np.array([3, 199, 91])], bags[[3, 199, 91]])
    one, other = qm.train(bags, np.array(labels)), qm.train(sparse, np.array(labels))
    assert np.array_equal(one.vectors, other.vectors) and np.array_equal(one.bias, other.bias)


def test_the_driver_never_holds_all_bags_dense(spark):
    texts, labels = sample(900)
    buckets = 1 << 15
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    marks = spark.createDataFrame(list(enumerate(labels)), "doc_id LONG, quality INT")
    tracemalloc.start()
    try:
        assert qm.fit(docs, marks, buckets=buckets) is not None
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 550 * buckets * 4  # about 600 of the rows are not held out

"""Topic inference and online variational Bayes for latent Dirichlet allocation, in batches of documents.

The rules are those of Spark's online optimiser: its mini-batches of 5 %, step sizes, stopping rule of the inference and
estimate of the document concentration. What differs is how the work is laid out: documents of about one length are
solved together in arrays instead of one by one, and the vectors are dealt into mini-batches once, as a stored table, so that an
iteration reads its own mini-batch and not all vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
from pyspark.ml.clustering import LDA, LocalLDAModel
from pyspark.ml.linalg import DenseMatrix, DenseVector, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storytide.workspace import fresh_path

BATCHES = 20  # a mini-batch is 5 % of the documents, as in Spark
OFFSET, DECAY, SHAPE = 1024.0, 0.51, 100.0  # Spark's step sizes and first topics
SUMS = 1 << 26  # bytes of the sums that the driver is sent in an iteration, beyond one task a core
CHANGE = 1e-3  # mean change of a mixture's parameters below which it is settled
HELD_TERMS = 1 << 19  # terms of documents that a task solves together
BLOCK = 1 << 13  # terms of a block of documents of about one length


def digamma(x: np.ndarray) -> np.ndarray:
    below, far = np.zeros_like(x), x + 8
    for i in range(8):
        below += 1 / (x + i)
    w = 1 / (far * far)
    return np.log(far) - 0.5 / far - w * (1 / 12 - w * (1 / 120 - w * (1 / 252 - w * (1 / 240 - w * (1 / 132))))) - below


def trigamma(x: np.ndarray) -> np.ndarray:
    below, far = np.zeros_like(x), x + 8
    for i in range(8):
        below += 1 / (x + i) ** 2
    w = 1 / (far * far)
    return 1 / far + w / 2 + w / far * (1 / 6 - w * (1 / 30 - w * (1 / 42 - w * (1 / 30)))) + below


def shares_of_words(topics: np.ndarray) -> np.ndarray:
    """exp of the expected logarithm of each word's probability (rows) in each topic (columns)."""
    return np.exp(digamma(topics) - digamma(topics.sum(axis=0)))


def counted_terms(features: DataFrame, *columns: str) -> DataFrame:
    """``columns`` with the ``ids`` and ``counts`` of the vector column ``features``, and its ``size``."""
    vector = F.unwrap_udt("features")
    all_ids = F.sequence(F.lit(0), F.size(vector["values"]) - 1)
    size = F.coalesce(vector["size"], F.size(vector["values"]))
    return features.select(*columns, F.coalesce(vector["indices"], all_ids).alias("ids"), vector["values"].alias("counts"), size.alias("size"))


def solver(beta: np.ndarray, alpha: np.ndarray) -> Callable:
    """A function that is sent to the tasks as it stands: documents (offsets, ids, counts) to the parameters of their mixtures.

    A document is solved by itself, from the same start whatever stands beside it, until its own parameters settle.
    """
    change, block = CHANGE, BLOCK

    def solve(offsets, ids, counts, each=None):
        import numpy as np

        topics = len(alpha)

        def weights(x):
            """exp(digamma(x)), by eight steps up and the series there. Its scale cancels out below."""
            y = x * (x + 7)
            below = (2 * x + 7) * (1 / y + 1 / (y + 6) + 1 / (y + 10) + 1 / (y + 12))
            z = x + 7.5
            w = 1 / (z * z)
            return (z + (1 / 24 - w * (37 / 5760 - w * (10313 / 2903040 - w * (5509121 / 1393459200)))) / z) * np.exp(-below)

        sizes = np.diff(offsets)
        result = np.tile(alpha, (len(sizes), 1))
        order = np.argsort(sizes, kind="stable")
        start = int(np.searchsorted(sizes[order], 1))
        while start < len(order):
            # Documents of about one length; shorter ones are filled up with terms that count nothing.
            shortest = int(sizes[order[start]])
            longest = max(shortest + 1, shortest * 9 // 8)
            stop = int(np.searchsorted(sizes[order], longest, side="right"))
            stop = min(stop, start + max(1, block // shortest))
            rows, width = order[start:stop], int(sizes[order[stop - 1]])
            inside = np.arange(width)[:, None] < sizes[rows]
            at = np.where(inside, offsets[rows] + np.arange(width)[:, None], 0)
            terms = ids[at]
            n = np.where(inside, counts[at], 0.0)
            b = beta[terms].transpose(2, 0, 1).copy()  # topic, place, document
            first = np.ascontiguousarray((alpha + (n.sum(axis=0) / topics)[:, None]).T)
            gamma, theta = first, weights(first)
            ends, open_ = np.empty_like(theta), np.arange(len(rows))
            settled = np.zeros(len(rows), bool)
            bb, nn = b, n
            while len(open_):
                shared = nn / (np.einsum("kd,knd->nd", theta, bb) + 1e-100)
                fresh = theta * np.einsum("knd,nd->kd", bb, shared) + alpha[:, None]
                done = ~(np.abs(fresh - gamma).mean(axis=0) > change) & ~settled
                gamma, theta = fresh, weights(fresh)
                if done.any():
                    result[rows[open_[done]]] = gamma[:, done].T
                    ends[:, open_[done]] = theta[:, done]
                    settled |= done
                    if settled.sum() * 3 > len(open_):
                        left = ~settled
                        open_, gamma, theta = open_[left], gamma[:, left].copy(), theta[:, left].copy()
                        bb, nn, settled = bb[:, :, left].copy(), nn[:, left].copy(), settled[left]
            if each is not None:
                shared = n / (np.einsum("kd,knd->nd", ends, b) + 1e-100)
                each(rows, terms, n, shared, ends)
            start = stop
        return result

    return solve


def _documents(column_names: Sequence[str]) -> Callable:
    """A function that is sent to the tasks as it stands: Arrow batches to tables of documents that are solved together."""
    held_terms, names = HELD_TERMS, list(column_names)

    def documents(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def told(held):
            table = pa.Table.from_batches(held).combine_chunks()
            lists, values = table["ids"].combine_chunks(), table["counts"].combine_chunks()
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            return table.select(names), offsets, lists.flatten().to_numpy(zero_copy_only=False), values.flatten().to_numpy(zero_copy_only=False)

        held, size = [], 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            size += len(batch.column("ids").flatten()) + len(batch)
            if size >= held_terms:
                yield told(held)
                held, size = [], 0
        if held:
            yield told(held)

    return documents


def mixtures(features: DataFrame, columns: Sequence[str], topics: np.ndarray, alpha: np.ndarray, result: str) -> DataFrame:
    """``columns`` and the topic mixture of each vector; a vector without terms has zeros."""
    solve, documents, names = solver(shares_of_words(topics), alpha), _documents(columns), [*columns, result]
    rows = counted_terms(features, *columns).drop("size")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for table, offsets, ids, counts in documents(batches):
            gamma = solve(offsets, ids, counts)
            mixed = gamma / gamma.sum(axis=1, keepdims=True)
            mixed[np.diff(offsets) == 0] = 0
            for start in range(0, len(table), 4096):
                part = mixed[start : start + 4096]
                lists = pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * part.shape[1], pa.array(part.reshape(-1)))
                given = table.slice(start, 4096).combine_chunks()
                yield from pa.table([*given.columns, lists], names=names).to_batches()

    schema = rows.select(*columns).schema.add(result, T.ArrayType(T.DoubleType()))
    return rows.mapInArrow(run, schema)


def log_chances(features: DataFrame, topics: np.ndarray, alpha: np.ndarray) -> float:
    """The logarithm of the probability of all words that are counted, each drawn from the mixture of its document."""
    solve, documents, shares = solver(shares_of_words(topics), alpha), _documents([]), topics / topics.sum(axis=0)
    rows = counted_terms(features).drop("size")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = 0.0
        for _, offsets, ids, counts in documents(batches):
            gamma = solve(offsets, ids, counts)
            mixed = gamma / gamma.sum(axis=1, keepdims=True)
            owners = np.repeat(np.arange(len(mixed)), np.diff(offsets))
            for start in range(0, len(ids), 1 << 16):
                part = slice(start, start + (1 << 16))
                total += float(counts[part] @ np.log(np.einsum("tk,tk->t", mixed[owners[part]], shares[ids[part]])))
        yield pa.RecordBatch.from_pydict({"s": [total]})

    return rows.mapInArrow(run, "s double").agg(F.sum("s").alias("s")).first().s


def mini_batches(features: DataFrame, seed: int) -> DataFrame:
    """The vectors dealt by chance into mini-batches: ``ids, counts, size`` of each and its ``batch``, as a stored table.

    The vectors are computed once. A fit passes over the mini-batches in turn, so an iteration reads a twentieth of the table.
    """
    spark = features.sparkSession
    batch = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)), F.lit(BATCHES)).cast("int")
    rows = counted_terms(features).withColumn("batch", batch)
    path = fresh_path(spark, "mini_batches")
    rows.write.partitionBy("batch").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _sums(beta: np.ndarray, alpha: np.ndarray) -> Callable:
    """For one mini-batch: the documents with terms, their sum of expected logarithms, and the terms' sums by topic."""
    solve, documents = solver(beta, alpha), _documents([])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        words, topics = beta.shape
        sums, logs, many = np.zeros((topics, words)), np.zeros(topics), 0
        seen: list = []

        def each(rows, terms, n, shared, ends):
            seen.append((terms.reshape(-1), (shared * ends[:, None, :]).reshape(topics, -1)))

        for _, offsets, ids, counts in documents(batches):
            gamma = solve(offsets, ids, counts, each)
            gamma = gamma[np.diff(offsets) > 0]
            if not len(gamma):
                continue
            terms = np.concatenate([t for t, _ in seen])
            weights = np.concatenate([w for _, w in seen], axis=1)
            seen.clear()
            for k in range(topics):
                sums[k] += np.bincount(terms, weights[k], words)
            logs += (logarithms(gamma) - logarithms(gamma.sum(axis=1, keepdims=True))).sum(axis=0)
            many += len(gamma)
        if many:
            yield pa.RecordBatch.from_pydict({"n": [many], "logs": [logs.tobytes()], "sums": [sums.tobytes()]})

    def logarithms(x):
        import numpy as np

        below, far = np.zeros_like(x), x + 8
        for i in range(8):
            below += 1 / (x + i)
        w = 1 / (far * far)
        return np.log(far) - 0.5 / far - w * (1 / 12 - w * (1 / 120 - w * (1 / 252 - w * (1 / 240 - w * (1 / 132))))) - below

    return run


def fit(batches: DataFrame, num_topics: int, max_iter: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the words (rows) in the topics (columns), and the document concentration, after ``max_iter`` mini-batches."""
    known = batches.agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("words")).first()
    if not known.n:
        raise ValueError("there are no vectors to find topics in")
    cores = batches.sparkSession.sparkContext.defaultParallelism
    rng = np.random.default_rng(seed)
    weights = rng.gamma(SHAPE, 1 / SHAPE, (num_topics, known.words)).T
    alpha, eta = np.full(num_topics, 1 / num_topics), 1 / num_topics
    size, tasks = -(-known.n // BATCHES), max(cores, min(4 * cores, SUMS // weights.nbytes))
    done = 0
    for turn in range(max_iter):
        beta = shares_of_words(weights)
        rows = batches.where(F.col("batch") == turn % BATCHES).select("ids", "counts").coalesce(tasks)
        told = rows.mapInArrow(_sums(beta, alpha), "n long, logs binary, sums binary").collect()
        many = sum(row.n for row in told)
        if not many:  # as with an empty sample, nothing is learnt
            continue
        sums, logs = np.zeros((num_topics, known.words)), np.zeros(num_topics)
        for row in told:
            sums += np.frombuffer(row.sums).reshape(sums.shape)
            logs += np.frombuffer(row.logs)
        done += 1
        rate = (OFFSET + done) ** -DECAY
        weights = (1 - rate) * weights + rate * (sums.T * beta * (known.n / size) + eta)
        alpha = _next_concentration(alpha, logs / many, many, rate)
    return weights, alpha


def _next_concentration(alpha: np.ndarray, logs: np.ndarray, many: int, rate: float) -> np.ndarray:
    """A step of Newton's method for the document concentration (Huang, appendix A.4), kept if all stay positive."""
    gradient = many * (digamma(alpha.sum()[None]) - digamma(alpha) + logs)
    common, own = many * trigamma(alpha.sum()[None])[0], -many * trigamma(alpha)
    level = (gradient / own).sum() / (1 / common + (1 / own).sum())
    moved = alpha - rate * (gradient - level) / own
    return moved if (moved > 0).all() else alpha


def as_model(batches: DataFrame, weights: np.ndarray, alpha: np.ndarray, max_iter: int, seed: int) -> LocalLDAModel:
    """The topics as Spark's own model: its saved form, with these topics in place of its own."""
    spark, topics = batches.sparkSession, len(alpha)
    one = spark.createDataFrame([(Vectors.dense([1.0, 1.0]),)], ["features"])
    form = LDA(k=topics, maxIter=1, seed=seed, featuresCol="features", topicDistributionCol="topics", subsamplingRate=1.0).fit(one)
    form._set(maxIter=max_iter, subsamplingRate=1 / BATCHES)
    form._transfer_params_to_java()
    path = fresh_path(spark, "topics")
    form.write().save(path)
    schema = spark.read.parquet(f"{path}/data").schema
    values = {
        "vocabSize": len(weights),
        "topicsMatrix": DenseMatrix(*weights.shape, weights.reshape(-1, order="F")),
        "docConcentration": DenseVector(alpha),
        "topicConcentration": 1 / topics,
        "gammaShape": SHAPE,
    }
    spark.createDataFrame([tuple(values[name] for name in schema.names)], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    return LocalLDAModel.load(path)


def of_model(model) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the words in the topics and document concentration of a model."""
    return model.topicsMatrix().toArray(), model.estimatedDocConcentration().toArray()

"""Registered queries: expression graphs, tiled products, one-pass softmax, tree reduction, and the larger ways to train."""

from __future__ import annotations

import gzip
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tablegrad.functions import columns as C
from tablegrad.operators import activations, batching, nn, packets, tiles
from tablegrad.operators.graph import Graph
from tablegrad.plans import data as D
from tablegrad.plans import sqlparts as S
from tablegrad.plans import train as TR
from tablegrad.plans import train_bn as BN
from tablegrad.plans import train_local as TL
from tablegrad.plans.catalog import register, weight_cells
from tablegrad.session import scratch_path
from tablegrad.sources import idx, kv, ranges

G = 9


def tagged(df, name: str, i=None, j=None, v: str = "grad", digits: int = G):
    """Cells of one tensor as (tensor, i, j, grad)."""
    zero = F.lit(0).cast("bigint")
    return df.select(F.lit(name).alias("tensor"), (F.col(i).cast("bigint") if i else zero).alias("i"),
                     (F.col(j).cast("bigint") if j else zero).alias("j"), C.tidy(v, digits).alias("grad"))


def union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def tagged_rows(df, name: str, id_col: str = "row_id"):
    return tagged(df.select(id_col, F.posexplode("grad").alias("j", "grad")), name, id_col, "j")


def tagged_sql(name: str, source: str, i: str = "0", j: str = "0", g: str = "g", digits: int = G) -> str:
    return f"SELECT '{name}' AS tensor, CAST({i} AS BIGINT) AS i, CAST({j} AS BIGINT) AS j, {S.r(g, digits)} AS grad FROM {source}"


# ================================================================ gradients of expressions
@register("grad_graph", S.with_(
    S.EMB, S.weights("w", 64, 64), S.bias("b", 64), "n AS (SELECT count(*) * 64.0 AS mn FROM embeddings)",
    "z AS (SELECT emb.row_id, w.j, sum(emb.x * w.w) AS s FROM emb JOIN w ON emb.j = w.k GROUP BY emb.row_id, w.j)",
    "h AS (SELECT z.row_id, z.j, s + b AS z, greatest(s + b, 0.0) AS h FROM z JOIN b USING (j))",
    "up AS (SELECT h.row_id, h.j, x, 2.0 * (x + h) / mn AS dr, CASE WHEN z > 0 THEN 2.0 * (x + h) / mn + 0.5 / mn ELSE 0.0 END AS dz "
    "FROM h JOIN emb ON emb.row_id = h.row_id AND emb.j = h.j CROSS JOIN n)",
    "back AS (SELECT up.row_id, w.k AS j, sum(up.dz * w.w) AS s FROM up JOIN w ON up.j = w.j GROUP BY up.row_id, w.k)",
    "dx AS (SELECT up.row_id, up.j, dr + s AS g FROM up JOIN back ON back.row_id = up.row_id AND back.j = up.j)",
    "dw AS (SELECT emb.j AS k, up.j, sum(emb.x * up.dz) AS g FROM emb JOIN up ON emb.row_id = up.row_id GROUP BY emb.j, up.j)",
    "db AS (SELECT j, sum(dz) AS g FROM up GROUP BY j)")
    + " UNION ALL ".join([tagged_sql("x", "dx", "row_id", "j"), tagged_sql("w", "dw", "k", "j"), tagged_sql("b", "db", "0", "j")]))
def q_grad_graph(spark, d):
    """A residual expression: h = relu(x W + b), loss = mean((x + h)^2) + mean(h) / 2. x and h have two consumers each."""
    g = Graph(D.emb_rows(spark, d).select("row_id", "vec"))
    x, w, b = g.matrix("vec"), g.weights(D.formula_w(64, 64)), g.vector(D.formula_b(64))
    h = (x @ w + b).relu()
    loss = (x + h).pow(2.0).mean() + h.mean() * 0.5
    dx, dw, db = g.gradients(loss, [x, w, b])
    return union([tagged_rows(dx, "x"), tagged(dw, "w", "k", "j"), tagged(db, "b", None, "j")])


@register("grad_graph_centred", S.with_(
    S.EMB, "v AS (SELECT CAST(j AS INTEGER) AS j, (j + 1) / 64.0 AS v FROM range(0, 64) t(j))",
    "mu AS (SELECT j, avg(x) AS mu FROM emb GROUP BY j)",
    "c AS (SELECT row_id, emb.j, x - mu AS c, v, (x - mu) * v * 8.0 AS z FROM emb JOIN mu USING (j) JOIN v USING (j))",
    "m AS (SELECT row_id, max(z) AS m FROM c GROUP BY row_id)", "e AS (SELECT c.*, exp(z - m) AS e FROM c JOIN m USING (row_id))",
    "s AS (SELECT row_id, sum(e) AS s FROM e GROUP BY row_id)", "y AS (SELECT e.*, e / s AS y FROM e JOIN s USING (row_id))",
    "t AS (SELECT row_id, sum(c * y) AS t FROM y GROUP BY row_id)",
    # loss = sum(c * y): dc = y + 8 v * dz with dz = y (c - t); dv = sum over rows of 8 c dz; dx = dc - mean(dc)
    "g AS (SELECT y.*, y + 8.0 * v * y * (c - t) AS dc, 8.0 * c * y * (c - t) AS dv FROM y JOIN t USING (row_id))",
    "dm AS (SELECT j, avg(dc) AS m FROM g GROUP BY j)", "dx AS (SELECT row_id, g.j, dc - m AS g FROM g JOIN dm USING (j))",
    "dv AS (SELECT j, sum(dv) AS g FROM g GROUP BY j)")
    + tagged_sql("x", "dx", "row_id", "j") + " UNION ALL " + tagged_sql("v", "dv", "0", "j"))
def q_grad_graph_centred(spark, d):
    """Sums over all rows in the middle of the expression: c = x - mean(x), loss = sum(c * softmax(8 c v))."""
    g = Graph(D.emb_rows(spark, d).select("row_id", "vec"))
    x, v = g.matrix("vec"), g.vector((np.arange(64) + 1) / 64.0)
    c = x - x.mean(0)
    dx, dv = g.gradients((c * (c * v * 8.0).softmax()).sum(), [x, v], save=True)
    return tagged_rows(dx, "x").unionByName(tagged(dv, "v", None, "j"))


@register("grad_seed", S.with_(S.EMB, "u AS (SELECT row_id, j, x, CAST(list_extract(list_reverse(embedding), j + 1) AS DOUBLE) AS g FROM emb JOIN embeddings ON row_id = vec_id)")
          + " UNION ALL ".join([tagged_sql("ones", "u", "row_id", "j", "2.0 * x"), tagged_sql("given", "u", "row_id", "j", "2.0 * x * g")]))
def q_grad_seed(spark, d):
    """The upstream gradient of a tensor that is no scalar: ones where none is given, or a column."""
    g = Graph(D.emb_rows(spark, d).select("row_id", "vec", F.reverse("vec").alias("up")))
    x = g.matrix("vec")
    y = x * x
    return tagged_rows(g.gradients(y, [x])[0], "ones").unionByName(tagged_rows(g.gradients(y, [x], seed="up")[0], "given"))


# ================================================================ large matrices
def emb_tiles(spark, d, size: int = 32):
    cells = D.emb_rows(spark, d).select(F.col("row_id").alias("i"), F.posexplode("vec").alias("j", "v"))
    return tiles.from_cells(cells, id_range(spark, d), 64, size)


@register("matmul_tiles", S.with_(S.EMB, "g AS (SELECT a.j AS k, b.j, sum(a.x * b.x) AS w FROM emb a JOIN emb b ON a.row_id = b.row_id GROUP BY a.j, b.j)")
          + f"SELECT emb.row_id AS i, CAST(g.j AS BIGINT) AS j, {S.r('sum(emb.x * g.w)')} AS v FROM emb JOIN g ON emb.j = g.k GROUP BY emb.row_id, g.j")
def q_matmul_tiles(spark, d):
    """X (Xᵀ X) of all embeddings: a product along the rows, then one along the columns."""
    x = emb_tiles(spark, d)
    out = tiles.to_cells(tiles.matmul(x, tiles.matmul(x, x, transpose_a=True, span=4), region=2))
    return out.select("i", "j", C.tidy("v").alias("v"))


@register("grad_matmul_tiles", S.with_(
    S.EMB, S.weights("w", 64, 48), "g AS (SELECT r.row_id, w.j, 0.01 * (r.row_id % 7 + w.j) AS g FROM (SELECT DISTINCT row_id FROM emb) r, (SELECT DISTINCT j FROM w) w)",
    "da AS (SELECT g.row_id, w.k, sum(g.g * w.w) AS g FROM g JOIN w ON g.j = w.j GROUP BY g.row_id, w.k)",
    "db AS (SELECT emb.j AS k, g.j, sum(emb.x * g.g) AS g FROM emb JOIN g ON emb.row_id = g.row_id GROUP BY emb.j, g.j)")
    + tagged_sql("a", "da", "row_id", "k", digits=8) + " UNION ALL " + tagged_sql("b", "db", "k", "j", digits=8))
def q_grad_matmul_tiles(spark, d):
    a = emb_tiles(spark, d)
    b = tiles.from_cells(weight_cells(spark, 64, 48), 64, 48, 32, i="k")
    up = D.emb_rows(spark, d).select(F.col("row_id").alias("i"), F.posexplode(F.sequence(F.lit(0), F.lit(47))).alias("j", "_s"))
    g = tiles.from_cells(up.select("i", "j", ((F.col("i") % 7 + F.col("j")) * 0.01).alias("v")), a.m, 48, 32)
    da, db = tiles.grad_matmul(a, b, g)
    return union([tagged(tiles.to_cells(t), n, "i", "j", "v", 8) for n, t in (("a", da), ("b", db))])


# ================================================================ softmax in one pass
LOGITS_SQL = "c AS (SELECT vec_id AS row_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j, CAST(unnest(embedding) AS DOUBLE) * 2000.0 AS x FROM embeddings)"
LSE_SQL = ["m AS (SELECT j, max(x) AS m FROM c GROUP BY j)", "t AS (SELECT c.j, m + ln(sum(exp(x - m))) AS lse FROM c JOIN m USING (j) GROUP BY c.j, m)"]


def logit_cells(spark, d):
    """Embeddings times 2,000 (from about -1,100 to 1,100) as (pos, v) cells of an [ids, 64] tensor."""
    rows = D.emb_rows(spark, d)
    return rows.select("row_id", F.posexplode("vec").alias("j", "x")).select((F.col("row_id") * 64 + F.col("j")).alias("pos"), (F.col("x") * 2000.0).alias("v"))


def id_range(spark, d) -> int:
    return (D.table(spark, d, "embeddings").agg(F.max("vec_id")).first()[0] or 0) + 1


@register("softmax_stream", S.with_(LOGITS_SQL, *LSE_SQL) + f"SELECT row_id * 64 + c.j AS pos, {S.r('exp(x - lse)', 9)} AS p FROM c JOIN t USING (j)")
def q_softmax_stream(spark, d):
    """Softmax down each column (as long as the table) of large logits."""
    return activations.softmax_stream(logit_cells(spark, d), (id_range(spark, d), 64), 0).select("pos", C.tidy("p", 9).alias("p"))


@register("log_sum_exp", S.with_(LOGITS_SQL, *LSE_SQL) + f"SELECT CAST(j AS BIGINT) AS pos, {S.r('lse')} AS lse FROM t")
def q_log_sum_exp(spark, d):
    return activations.log_sum_exp(logit_cells(spark, d), (id_range(spark, d), 64), 0).select("pos", C.tidy("lse").alias("lse"))


# ================================================================ tree reduction
@register("grad_tree_depth", S.with_(S.EMB, "t AS (SELECT j, sum(x) AS g FROM emb GROUP BY j)") + " UNION ALL ".join(
    f"SELECT {k} AS depth, CAST(j AS BIGINT) AS pos, (SELECT count(*) FROM embeddings) AS n, {S.r('g', 8)} AS grad FROM t" for k in (1, 2, 3)))
def q_grad_tree_depth(spark, d):
    """The sum of the embeddings as packets (each row is one, two blocks of 32), reduced by trees of depth 1 to 3."""
    rows = D.emb_rows(spark, d)
    pk = rows.select(F.posexplode(F.array(F.slice("vec", 1, 32), F.slice("vec", 33, 32))).alias("block", "grad"), F.lit(1).cast("bigint").alias("n"))
    out = [packets.tree_sum(pk.repartition(16), k, tasks=16).select(F.lit(k).alias("depth"), "block", "n", F.posexplode("grad").alias("at", "g")) for k in (1, 2, 3)]
    return union(out).select("depth", (F.col("block").cast("bigint") * 32 + F.col("at")).alias("pos"), "n", C.tidy("g", 8).alias("grad"))


# ================================================================ shuffling by arithmetic
def _permutation_sql(seed: int, epoch: int, walks: int = 4) -> str:
    def passed(x):
        """One pass of the Feistel rounds as nested SELECTs over a column x; n is the number of rows."""
        q = f"SELECT r, n, a, b, {x} // b AS l, {x} % b AS h FROM w"
        for i, key in enumerate(batching._keys(seed, epoch)):
            of, at, size = ("h", "l", "a") if i % 2 == 0 else ("l", "h", "b")
            shift = f"((({of} + {key}) % 2147483647) * (({of} + {key}) % 2147483647) % 2147483647 * 69621 + {key}) % 2147483647"
            other = "h" if at == "l" else "l"
            q = f"SELECT r, n, a, b, ({at} + {shift}) % {size} AS {at}, {other} FROM ({q})"
        return f"SELECT r, n, a, b, l * b + h AS x FROM ({q})"
    ctes = ["d AS (SELECT count(*)::BIGINT AS n, (floor(sqrt(count(*) - 1)) + 1)::BIGINT AS a FROM orders)",
            "w0 AS (SELECT o_orderkey AS r, n, a, ceil(n / a)::BIGINT AS b, o_orderkey AS x FROM orders CROSS JOIN d)",
            "w1 AS (" + passed("x").replace("FROM w", "FROM w0") + ")"]
    for k in range(1, walks):
        ctes.append(f"w{k + 1} AS (SELECT u.r, u.n, u.a, u.b, CASE WHEN u.x < u.n THEN u.x ELSE v.x END AS x FROM w{k} u JOIN ("
                    + passed("x").replace("FROM w", f"FROM w{k}") + ") v ON u.r = v.r)")
    return S.with_(*ctes) + (f"SELECT r AS id, x AS place, CAST(x % 8 AS INTEGER) AS part, x // 8 // 64 AS batch_id, "
                             f"CAST(least(64, (n - 1 - x % 8) // 8 + 1 - x // 8 // 64 * 64) AS INTEGER) AS bsize FROM w{walks}")


@register("shuffle_permutation", _permutation_sql(42, 1))
def q_shuffle_permutation(spark, d):
    """The shuffled batch of every order by arithmetic on its dense key: a plan without an exchange."""
    o = D.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    n = o.count()
    rows = batching.shuffled_batches(o.withColumn("place", batching.shuffle_permutation("id", n, 42, 1)), "id", n, 8, 64, 42, 1)
    return rows.select("id", "place", "part", "batch_id", "bsize")


# ================================================================ files by ranges, batches written once
@register("loss_log_ranges", "SELECT CAST(user_id % 4 AS INTEGER) AS part, CAST(row_number() OVER (PARTITION BY "
          f"user_id % 4 ORDER BY event_id) AS INTEGER) AS step, {S.r('abs(value)')} AS loss FROM events")
def q_loss_log_ranges(spark, d):
    """The events as UTF-16 log files, read again by byte ranges of 32 kB."""
    from tablegrad.plans.catalog_io import loss_log_files
    folder = scratch_path(spark, f"logs-{uuid.uuid4().hex}")
    files = loss_log_files(spark, d).select(F.regexp_replace("path", ".*/", "").alias("path"), "content")
    ranges.put_files(files, folder).write.format("noop").mode("overwrite").save()
    c = ranges.curve(ranges.read_lines(spark, folder, "UTF-16", range_bytes=32 << 10))
    return c.select("part", "step", C.tidy("loss").alias("loss"))


@register("idx_ranges", "SELECT vec_id // 100 AS shard, vec_id % 100 AS idx, label, list_sum([CAST(least(greatest(floor(x * 255.0 + 128.0), 0), 255) AS BIGINT) "
          "for x in list_transform(embedding, lambda y: y::DOUBLE)])::BIGINT AS total FROM embeddings")
def q_idx_ranges(spark, d):
    """Image and label files of 100 records (one shard in two unpacked), read by ranges of 10 records and as streams, and paired."""
    byte = lambda x: F.least(F.greatest(F.floor(x * 255.0 + 128.0), F.lit(0)), F.lit(255)).cast("int")
    rows = D.emb_rows(spark, d).select(F.floor(F.col("row_id") / 100).alias("shard"), (F.col("row_id") % 100).alias("idx"),
                                       F.unhex(F.array_join(F.transform("vec", lambda x: F.lpad(F.hex(byte(x)), 2, "0")), "")).alias("pixels"), "label")
    files = idx.idx_shard_files(rows, "shard", "idx", "pixels", "label", 8, 8)
    folder = scratch_path(spark, f"idx-{uuid.uuid4().hex}")
    ranges.put_files(unpacked(files), folder).write.format("noop").mode("overwrite").save()
    paired = idx.pair_images_labels(ranges.read_idx(spark, folder, range_bytes=640))
    total = F.aggregate(F.sequence(F.lit(1), F.length("pixels")), F.lit(0).cast("bigint"),
                        lambda s, i: s + F.conv(F.hex(F.substring(F.col("pixels"), i, F.lit(1))), 16, 10).cast("bigint"))
    return paired.select(F.col("shard").cast("bigint").alias("shard"), "idx", "label", total.alias("total"))


def unpacked(files):
    """The files of every second shard without gzip."""
    def run(batches):
        for b in batches:
            names, data = b.column(0).to_pylist(), b.column(1).to_pylist()
            plain = [int(n.split("-")[0]) % 2 == 0 for n in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n.removesuffix(".gz") if p else n for n, p in zip(names, plain)]), pa.array([gzip.decompress(x) if p else x for x, p in zip(data, plain)], pa.binary())],
                names=["path", "content"])
    return files.mapInArrow(run, "path string, content binary")


@register("kv_batches", S.with_(S.EMB) + f"SELECT printf('train_%05d', row_id) AS row_key, label AS label_idx, {S.r('sum(x)')} AS total FROM emb GROUP BY row_id, label")
def q_kv_batches(spark, d):
    """Samples written in three numbered batches, the second of them by two runs: it is there once."""
    from tablegrad.plans.catalog_io import kv_table
    t, path = kv_table(spark, d), scratch_path(spark, f"kv-{uuid.uuid4().hex}")
    third = F.pmod(F.xxhash64("row_key"), F.lit(3))
    for batch in (0, 1, 1, 2):
        kv.write_batch(t.where(third == batch), path, batch)
    s = kv.scan_samples(kv.read_batches(spark, path))
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x)
    return s.select("row_key", C.argmax("target").alias("label_idx"), C.tidy(total).alias("total"))


# ================================================================ training on orders
ORDERS_SQL = ("x AS (SELECT o_orderkey AS id, o_totalprice / 100000.0 AS f0, (o_custkey % 100) / 100.0 AS f1, (o_orderkey % 7) / 7.0 AS f2, "
              "(o_custkey % 10) / 10.0 + o_totalprice / 200000.0 AS t, o_orderkey % 4 AS part FROM orders)")


def order_samples(spark, d):
    o = D.table(spark, d, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(key.alias("row_id"), F.array(F.col("o_totalprice") / 100000.0, (cust % 100) / 100.0, (key % 7) / 7.0).alias("features"),
                    F.array((cust % 10) / 10.0 + F.col("o_totalprice") / 200000.0).alias("target"))


LINE = [nn.Linear(3, 1)]


def line_params():
    return [D.formula_w(3, 1), D.formula_b(1)]


START_SQL = f"SELECT {S.w_expr(0, 0)} AS w0, {S.w_expr(1, 0)} AS w1, {S.w_expr(2, 0)} AS w2, {S.b_expr(0)} AS b"
PRED = "(f0 * w0 + f1 * w1 + f2 * w2 + b)"


def _params_sql(source: str, digits: int = 9) -> str:
    return " UNION ALL ".join(f"SELECT {i} AS param_id, '{n}' AS name, CAST({pos} AS BIGINT) AS pos, {S.r(c, digits)} AS value FROM {source}"
                              for i, n, pos, c in ((0, "0.weight", 0, "w0"), (0, "0.weight", 1, "w1"), (0, "0.weight", 2, "w2"), (1, "0.bias", 0, "b")))


def _local_sql(lr: float, rounds: int, steps: int) -> str:
    ctes = [ORDERS_SQL, f"xs AS (SELECT *, ((row_number() OVER (PARTITION BY part ORDER BY id) - 1) // 64) % {steps} AS s FROM x)", f"r0 AS ({START_SQL})"]
    for r in range(rounds):
        ctes.append(f"q{r}_0 AS (SELECT part, w0, w1, w2, b FROM (SELECT DISTINCT part FROM x) CROSS JOIN r{r})")
        for k in range(steps):
            e = f"2.0 * ({PRED} - t)"
            ctes.append(f"g{r}_{k} AS (SELECT xs.part, avg({e} * f0) AS g0, avg({e} * f1) AS g1, avg({e} * f2) AS g2, avg({e}) AS gb "
                        f"FROM xs JOIN q{r}_{k} q ON q.part = xs.part WHERE s = {k} GROUP BY xs.part)")
            ctes.append(f"q{r}_{k + 1} AS (SELECT q.part, " + ", ".join(f"{p} - {lr} * coalesce({g}, 0.0) AS {p}" for p, g in zip(("w0", "w1", "w2", "b"), ("g0", "g1", "g2", "gb")))
                        + f" FROM q{r}_{k} q LEFT JOIN g{r}_{k} g ON g.part = q.part)")
        ctes.append(f"r{r + 1} AS (SELECT " + ", ".join(f"sum(n * {p}) / sum(n) AS {p}" for p in ("w0", "w1", "w2", "b"))
                    + f" FROM q{r}_{steps} JOIN (SELECT part, count(*) AS n FROM x GROUP BY part) c USING (part))")
    return S.with_(*ctes) + _params_sql(f"r{rounds}")


@register("train_local_steps", _local_sql(0.3, 2, 2))
def q_train_local_steps(spark, d):
    """Two rounds of two local steps in each of four parts, models averaged by samples."""
    cfg = TR.TrainConfig(loss="mse", lr=0.3, epochs=2, batch_size=64, num_partitions=4)
    params = TL.train_local(spark, order_samples(spark, d), "row_id", "features", "target", LINE, line_params(), cfg, local_steps=2)
    return nn.params_to_table(spark, LINE, params).withColumn("value", C.tidy("value", 9))


class Momentum:
    """A user's optimizer: heavy ball, v = 0.9 v + g, p = p - lr v."""

    def __init__(self, lr: float):
        self.lr, self.v = lr, None

    def step(self, params, grads):
        self.v = [g if self.v is None else 0.9 * self.v[k] + g for k, g in enumerate(grads)]
        return [p - self.lr * v for p, v in zip(params, self.v)]


def _global_sql(lr: float, epochs: int, momentum: float) -> list[str]:
    ctes = [ORDERS_SQL, f"p0 AS ({START_SQL})", "v0 AS (SELECT 0.0 AS v0, 0.0 AS v1, 0.0 AS v2, 0.0 AS vb)"]
    e = f"2.0 * ({PRED} - t)"
    for k in range(epochs):
        ctes.append(f"g{k} AS (SELECT avg({e} * f0) AS g0, avg({e} * f1) AS g1, avg({e} * f2) AS g2, avg({e}) AS gb FROM x CROSS JOIN p{k})")
        ctes.append(f"v{k + 1} AS (SELECT " + ", ".join(f"{momentum} * v{c} + g{c} AS v{c}" for c in "012b") + f" FROM v{k} CROSS JOIN g{k})")
        ctes.append(f"p{k + 1} AS (SELECT w0 - {lr} * v0 AS w0, w1 - {lr} * v1 AS w1, w2 - {lr} * v2 AS w2, b - {lr} * vb AS b FROM p{k} CROSS JOIN v{k + 1})")
    return ctes


@register("custom_optimizer", S.with_(*_global_sql(0.2, 3, 0.9)) + _params_sql("p3"))
def q_custom_optimizer(spark, d):
    """Three global steps by a user's optimizer object."""
    cfg = TR.TrainConfig(loss="mse", optimizer=Momentum(0.2), epochs=3, batch_size=64, num_partitions=4)
    params, _ = TR.train(spark, order_samples(spark, d), "row_id", "features", "target", LINE, line_params(), cfg)
    return nn.params_to_table(spark, LINE, params).withColumn("value", C.tidy("value", 9))


@register("epoch_metrics", S.with_(*_global_sql(0.3, 3, 0.0), "b AS (SELECT *, (row_number() OVER (PARTITION BY part ORDER BY id) - 1) // 64 AS batch FROM x)",
                                   *(f"l{k} AS (SELECT part, batch, count(*) AS n, avg(power({PRED} - t, 2)) AS l FROM b AS x CROSS JOIN p{k} GROUP BY part, batch)".replace(
                                       "b AS x CROSS", "(SELECT id, f0, f1, f2, t, part, batch FROM b) CROSS") for k in range(3)))
          + " UNION ALL ".join(f"SELECT {k + 1} AS epoch, CAST(part AS INTEGER) AS part, CAST(count(*) AS INTEGER) AS batches, CAST(sum(n) AS BIGINT) AS n, "
                               f"{S.r('avg(l)', 9)} AS avg_batch_loss FROM l{k} GROUP BY part" for k in range(3)))
def q_epoch_metrics(spark, d):
    """What an epoch reports: batches, samples and the mean batch loss of every part, over three epochs."""
    cfg = TR.TrainConfig(loss="mse", lr=0.3, epochs=3, batch_size=64, num_partitions=4)
    _, hist = TR.train(spark, order_samples(spark, d), "row_id", "features", "target", LINE, line_params(), cfg)
    return hist.select("epoch", "part", "batches", "n", C.tidy("avg_batch_loss", 9).alias("avg_batch_loss"))


# ================================================================ batch norm over batches of any size
BN_LAYERS = [nn.Linear(3, 4), nn.BatchNorm1d(4), nn.Linear(4, 1)]


def bn_params():
    return [D.formula_w(3, 4), D.formula_b(4), np.array([1.0, 0.5, 1.5, 2.0]), np.array([0.1, -0.1, 0.2, 0.0]), D.formula_w(4, 1, 3), D.formula_b(1)]


GAMMA, BETA = "list_extract([1.0, 0.5, 1.5, 2.0], j + 1)", "list_extract([0.1, -0.1, 0.2, 0.0], j + 1)"
BN_SQL = [
    ORDERS_SQL, "xc AS (SELECT id, part, t, unnest([0, 1, 2, 3]) AS j, f0, f1, f2 FROM x)",
    f"z AS (SELECT *, f0 * {S.w_expr(0, 'j')} + f1 * {S.w_expr(1, 'j')} + f2 * {S.w_expr(2, 'j')} + {S.b_expr('j')} AS z FROM xc)",
    "st AS (SELECT part, j, count(*) AS n, avg(z) AS mu, var_pop(z) AS var FROM z GROUP BY part, j)"]
BN_BACK_SQL = [
    *BN_SQL, "h AS (SELECT z.*, n, 1.0 / sqrt(var + 1e-5) AS inv, (z.z - mu) / sqrt(var + 1e-5) AS xh FROM z JOIN st ON st.part = z.part AND st.j = z.j)",
    f"y AS (SELECT *, xh * {GAMMA} + {BETA} AS y, {S.w_expr('j', 0, 3)} AS w2 FROM h)",
    f"p AS (SELECT id, sum(y * w2) + {S.b_expr(0)} AS p FROM y GROUP BY id)", "m AS (SELECT count(*) AS m FROM x)",
    f"g AS (SELECT y.*, 2.0 * (p - t) / m AS e, 2.0 * (p - t) / m * w2 AS gy, 2.0 * (p - t) / m * w2 * {GAMMA} AS gx FROM y JOIN p USING (id) CROSS JOIN m)",
    "s AS (SELECT part, j, sum(gx) AS s1, sum(gx * xh) AS s2 FROM g GROUP BY part, j)",
    "dz AS (SELECT g.*, inv * (gx - s1 / n - xh * s2 / n) AS dz FROM g JOIN s ON s.part = g.part AND s.j = g.j)",
    "grads AS (" + " UNION ALL ".join([
        *(f"SELECT 0 AS param_id, '0.weight' AS name, {k} * 4 + j AS pos, sum(dz * f{k}) AS g FROM dz GROUP BY j" for k in range(3)),
        "SELECT 1, '0.bias', j, sum(dz) FROM dz GROUP BY j", "SELECT 2, '1.gamma', j, sum(gy * xh) FROM dz GROUP BY j", "SELECT 3, '1.beta', j, sum(gy) FROM dz GROUP BY j",
        "SELECT 4, '2.weight', j, sum(e * y) FROM dz GROUP BY j", "SELECT 5, '2.bias', 0, sum(e) FROM dz WHERE j = 0"]) + ")"]


@register("batchnorm_merged_grad", S.with_(*BN_BACK_SQL) + f"SELECT param_id, name, CAST(pos AS BIGINT) AS pos, {S.r('g', 9)} AS grad FROM grads")
def q_batchnorm_merged_grad(spark, d):
    """Gradients through batch norm where each of four batches is a quarter of the table."""
    cfg = TR.TrainConfig(loss="mse", batch_size=1 << 30, num_partitions=4)
    s = TR.prepare_samples(order_samples(spark, d), "row_id", "features", "target", cfg)
    grad = TR.gradient_cells(BN.merged_packets(s, BN_LAYERS, bn_params(), cfg), BN_LAYERS)
    return grad.select("param_id", "name", "pos", C.tidy("grad", 9).alias("grad"))


@register("train_eval_mode", S.with_(
    *BN_SQL, "h AS (SELECT id, z.j, z.part, (z.z - mu) / sqrt(var + 1e-5) AS xh, z.z FROM z JOIN st ON st.part = z.part AND st.j = z.j)",
    "r AS (SELECT j, avg(mu) * 0.1 AS rm, 0.9 + 0.1 * avg(var) AS rv FROM st GROUP BY j)",
    f"o AS (SELECT id, sum((xh * {GAMMA} + {BETA}) * {S.w_expr('j', 0, 3)}) + {S.b_expr(0)} AS tr, "
    f"sum(((z - rm) / sqrt(rv + 1e-5) * {GAMMA} + {BETA}) * {S.w_expr('j', 0, 3)}) + {S.b_expr(0)} AS ev FROM h JOIN r USING (j) GROUP BY id)")
    + f"SELECT id, 'train' AS mode, {S.r('tr')} AS y FROM o UNION ALL SELECT id, 'eval', {S.r('ev')} FROM o")
def q_train_eval_mode(spark, d):
    """One model in both modes: training uses the batch's statistics, evaluation the running ones after one step."""
    cfg = TR.TrainConfig(loss="mse", lr=0.0, batch_size=1 << 30, num_partitions=4, batch_norm="merged")
    rows = order_samples(spark, d)
    _, buffers, _ = TR.train_with_buffers(spark, rows, "row_id", "features", "target", BN_LAYERS, bn_params(), cfg)
    s = TR.prepare_samples(rows, "row_id", "features", "target", cfg)
    training = BN.forward_merged(s, BN_LAYERS, bn_params(), out_col="y").select("id", F.lit("train").alias("mode"), "y")
    evaluation = nn.forward_rows(rows.select(F.col("row_id").alias("id"), "features"), BN_LAYERS, bn_params(), "features", "y", bn_running=buffers)
    both = training.unionByName(evaluation.select("id", F.lit("eval").alias("mode"), "y"))
    return both.select("id", "mode", C.tidy(F.element_at("y", 1)).alias("y"))

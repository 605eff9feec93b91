"""Registered queries: layouts and shapes, batch norm, collectives, and the sources / sinks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegrad.functions import columns as C
from tablegrad.operators import batching, collectives, elementwise, layout, nn, reduce
from tablegrad.plans import data as D
from tablegrad.plans import sqlparts as S
from tablegrad.plans.catalog import LI_KEYS, cells, register
from tablegrad.sources import blobs, idx, kv, losslog

N_SQL = "(SELECT count(*) FROM embeddings)"


def emb_flat(spark, d) -> DataFrame:
    return layout.flat_cells(D.emb_rows(spark, d), D.EMB_DIM)


# ================================================================ layouts and shapes
@register("one_hot", f"SELECT vec_id AS row_id, CAST(c AS INTEGER) AS j, CASE WHEN c = label THEN 1.0 ELSE 0.0 END::DOUBLE "
          "AS v FROM embeddings, range(0, 10) t(c)")
def q_one_hot(spark, d):
    return cells(D.emb_rows(spark, d).select("row_id", C.one_hot("label", D.N_CLASSES).alias("t")), ["row_id"], "t")


@register("reshape_cells", S.with_(S.EMB) + "SELECT row_id * 64 + j AS pos, (row_id * 64 + j) // 16 AS d0, "
          f"(row_id * 64 + j) % 16 AS d1, {S.r('x')} AS v FROM emb")
def q_reshape_cells(spark, d):
    n = D.emb_rows(spark, d).count()
    out = layout.reshape_cells(emb_flat(spark, d), (n, 64), (-1, 16))
    return out.select("pos", "d0", "d1", C.tidy("v").alias("v"))


@register("flatten_rows", S.with_(S.EMB) + f"SELECT row_id * 64 + j AS pos, {S.r('x')} AS v FROM emb")
def q_flatten_rows(spark, d):
    return emb_flat(spark, d).select("pos", C.tidy("v").alias("v"))


@register("transpose_cells", S.with_(S.EMB) + f"SELECT j * {N_SQL} + row_id AS pos, {S.r('x')} AS v FROM emb")
def q_transpose_cells(spark, d):
    n = D.emb_rows(spark, d).count()
    out, _ = layout.permute_cells(emb_flat(spark, d), (n, 64))
    return out.select("pos", C.tidy("v").alias("v"))


@register("permute_3d", S.with_(S.EMB) + f"SELECT (j % 8) * ({N_SQL} * 8) + row_id * 8 + j // 8 AS pos, "
          f"{S.r('x')} AS v FROM emb")
def q_permute_3d(spark, d):
    n = D.emb_rows(spark, d).count()
    out, _ = layout.permute_cells(emb_flat(spark, d), (n, 8, 8), axes=(2, 0, 1))
    return out.select("pos", C.tidy("v").alias("v"))


@register("grad_permute", S.with_(S.EMB) + "SELECT 'permute' AS rule, row_id * 64 + j AS pos, "
          f"{S.r('2.0 * x', 10)} AS grad FROM emb UNION ALL SELECT 'flatten', row_id * 64 + j, {S.r('3.0 * x', 10)} "
          "FROM emb")
def q_grad_permute(spark, d):
    """Backward of permute (inverse permutation) and of flatten (reshape back), with data-derived upstream G."""
    n = D.emb_rows(spark, d).count()
    shape, axes = (n, 8, 8), (2, 0, 1)
    fwd, fshape = layout.permute_cells(emb_flat(spark, d), shape, axes)
    g = fwd.select("pos", (F.col("v") * 2.0).alias("v"))              # upstream gradient of the permuted tensor
    back, bshape = layout.permute_cells(g, fshape, layout.inverse_axes(axes))
    assert tuple(bshape) == shape
    gf = emb_flat(spark, d).select("pos", (F.col("v") * 3.0).alias("v"))  # upstream gradient of the flattened tensor
    unflat = layout.reshape_cells(gf, (n * 64,), (n, 64))
    return (back.select(F.lit("permute").alias("rule"), "pos", C.tidy("v", 10).alias("grad"))
            .unionByName(unflat.select(F.lit("flatten").alias("rule"), "pos", C.tidy("v", 10).alias("grad"))))


@register("stack_rows", S.with_(S.EMB) + f"SELECT 0 AS rank, row_id, j, {S.r('x')} AS v FROM emb UNION ALL "
          f"SELECT 1, {N_SQL} + row_id, j, {S.r('2.0 * x')} FROM emb")
def q_stack_rows(spark, d):
    rows = D.emb_rows(spark, d).select("row_id", "vec")
    n = rows.count()
    st = layout.stack_rows([rows, rows.select("row_id", C.arr_scalar("mul", "vec", 2.0).alias("vec"))], n, D.EMB_DIM)
    return cells(st, ["rank", "row_id"], "vec")


@register("take_rows", S.with_(S.EMB) + f"SELECT i.out_row AS row_id, emb.j, {S.r('emb.x')} AS v FROM "
          f"(SELECT vec_id AS out_row, (vec_id * 6) % {N_SQL} AS src_row FROM embeddings) i "
          "JOIN emb ON emb.row_id = i.src_row")
def q_take_rows(spark, d):
    rows = D.emb_rows(spark, d).select("row_id", "vec")
    n = rows.count()
    index = D.table(spark, d, "embeddings").select(F.col("vec_id").alias("out_row"),
                                                   ((F.col("vec_id") * 6) % n).alias("src_row"))
    return cells(layout.take_rows(rows, index), ["row_id"], "vec")


@register("shape_check", "SELECT o_custkey, CAST(count(*) AS INTEGER) AS actual, 10 AS expected FROM orders "
          "GROUP BY o_custkey HAVING count(*) <> 10")
def q_shape_check(spark, d):
    """Each customer's order-price vector must have 10 entries; report the rest (a vector per customer)."""
    prices = D.table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list("o_totalprice").alias("vec"))
    return layout.shape_check(prices, "vec", 10, ["o_custkey"])


@register("int_to_tensor", "WITH c AS (SELECT l_orderkey, l_linenumber, "
          "unnest([l_linenumber, CAST(floor(l_quantity) AS INTEGER)]) AS x, "
          "unnest(range(0, 2)) AS j FROM lineitem) SELECT l_orderkey, l_linenumber, CAST(j AS INTEGER) AS j, "
          "CAST(x AS DOUBLE) AS v FROM c")
def q_int_to_tensor(spark, d):
    li = D.table(spark, d, "lineitem").select(*LI_KEYS, F.array(F.col("l_linenumber"),
                                                                F.floor("l_quantity").cast("int")).alias("ints"))
    return cells(li.select(*LI_KEYS, elementwise.int_to_tensor("ints", 2).alias("t")), LI_KEYS, "t")


def _rand_sql() -> str:
    m = 2147483647
    u = [f"((((({100 + k} + l_orderkey + 1) * 48271) % {m} * 69621 + 12345) % {m} + l_linenumber + 1) * 48271 % {m} * 69621 + 12345) % {m}"
         for k in range(4)]
    return ("WITH u AS (SELECT l_orderkey, l_linenumber, unnest([" + ", ".join(f"(({x}) % 1000003) / 1000003.0" for x in u)
            + f"]) AS v, unnest(range(0, 4)) AS j FROM lineitem) SELECT l_orderkey, l_linenumber, CAST(j AS INTEGER) AS j, {S.r('v')} AS v FROM u")


@register("rand_tensor", _rand_sql())
def q_rand_tensor(spark, d):
    """Uniform [0, 1) tensor shaped like the lineitem feature rows: hashed from the row keys, so it is reproducible."""
    r = F.array(*[nn.hashed_uniform(100 + k, *LI_KEYS) for k in range(4)])
    return cells(D.li_rows(spark, d).select(*LI_KEYS, r.alias("r")), LI_KEYS, "r")


# ================================================================ batch norm
BN_GAMMA = 1.0 + np.arange(4) / 4.0          # gamma[j] = 1 + j/4
BN_BETA = (np.arange(4) - 1.0) / 10.0        # beta[j] = (j - 1)/10
BN_ORDER = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _bn_sql_cells() -> list[str]:
    return [f"bt AS (SELECT l_orderkey, l_linenumber, {S.LI_VEC} AS vec, CAST(l_orderkey % 4 AS INTEGER) AS part, "
            "CAST((row_number() OVER (PARTITION BY l_orderkey % 4 ORDER BY " + ", ".join(BN_ORDER)
            + ") - 1) // 256 AS INTEGER) AS batch_id FROM lineitem)",
            "c AS (SELECT l_orderkey, l_linenumber, part, batch_id, CAST(generate_subscripts(vec, 1) - 1 AS INTEGER) "
            "AS j, unnest(vec) AS x FROM bt)"]


@register("batchnorm_train", S.with_(*_bn_sql_cells(),
                                     "st AS (SELECT part, batch_id, j, avg(x) AS mu, var_pop(x) AS var FROM c "
                                     "GROUP BY part, batch_id, j)")
          + "SELECT l_orderkey, l_linenumber, c.j, "
          + S.r("(x - mu) / sqrt(var + 1e-5) * (1.0 + c.j / 4.0) + (c.j - 1.0) / 10.0") + " AS y "
          "FROM c JOIN st USING (part, batch_id, j)")
def q_batchnorm_train(spark, d):
    li = D.table(spark, d, "lineitem")
    rows = li.select(*LI_KEYS, D.li_vec().alias("vec"), F.struct(*BN_ORDER).alias("ord"),
                     F.pmod("l_orderkey", F.lit(4)).cast("int").alias("part"))
    b = batching.assign_batches(rows, "ord", 4, 256)
    # one shuffle brings each batch whole into a task; a kernel normalises batch by batch, cells are exploded last
    out = nn.batchnorm_train_rows(b.select(*LI_KEYS, "part", "batch_id", "vec"), ["part", "batch_id"], BN_GAMMA, BN_BETA)
    return cells(out, LI_KEYS, "y", v="y")


@register("batchnorm_eval", S.with_(S.LI, S.LIC, "st AS (SELECT j, avg(x) AS mu, var_pop(x) AS var FROM lic GROUP BY j)")
          + "SELECT l_orderkey, l_linenumber, j, "
          + S.r("(x - mu) / sqrt(var + 1e-5) * (1.0 + j / 4.0) + (j - 1.0) / 10.0") + " AS y FROM lic JOIN st USING (j)")
def q_batchnorm_eval(spark, d):
    """Evaluation mode with running statistics taken from the data (per-feature mean / biased variance)."""
    x = D.li_rows(spark, d).select(*LI_KEYS, F.posexplode("vec").alias("j", "x"))
    buffers = x.groupBy("j").agg(F.avg("x").alias("running_mean"), F.var_pop("x").alias("running_var"))
    out = nn.batchnorm_eval_cells(x, buffers, BN_GAMMA, BN_BETA)
    return out.select(*LI_KEYS, "j", C.tidy("y").alias("y"))


@register("running_stats", S.with_(
    "c AS (SELECT event_id // 100 AS b, 0 AS j, value / 100.0 AS x FROM events UNION ALL "
    "SELECT event_id // 100, 1, user_id / 100.0 FROM events)",
    "bs AS (SELECT b, j, avg(x) AS mean, var_pop(x) AS var FROM c GROUP BY b, j)",
    "nb AS (SELECT max(b) + 1 AS n FROM bs)")
    + "SELECT j, " + S.r("power(0.9, n) * 0.0 + sum(0.1 * power(0.9, n - 1 - b) * mean)") + " AS running_mean, "
    + S.r("power(0.9, n) * 1.0 + sum(0.1 * power(0.9, n - 1 - b) * var)") + " AS running_var "
    "FROM bs CROSS JOIN nb GROUP BY j, n")
def q_running_stats(spark, d):
    ev = D.table(spark, d, "events").select((F.col("event_id") / 100).cast("bigint").alias("b"),
                                            F.array(F.col("value") / 100.0, F.col("user_id") / 100.0).alias("vec"))
    bs = (ev.select("b", F.posexplode("vec").alias("j", "x")).groupBy("b", "j")
          .agg(F.avg("x").alias("mean"), F.var_pop("x").alias("var")))
    rs = nn.running_stats(bs, "b", ["j"], momentum=0.1)
    return rs.select("j", C.tidy("running_mean").alias("running_mean"), C.tidy("running_var").alias("running_var"))


# ================================================================ collectives (job = vec_id div 4, rank = vec_id % 4)
RANKS_SQL = ("rk AS (SELECT vec_id // 4 AS job, CAST(vec_id % 4 AS INTEGER) AS rank, vec_id FROM embeddings)",
             "rc AS (SELECT vec_id // 4 AS job, CAST(vec_id % 4 AS INTEGER) AS rank, CAST(generate_subscripts("
             "embedding, 1) - 1 AS INTEGER) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)")


def ranks(spark, d) -> DataFrame:
    return D.emb_rows(spark, d).select((F.col("row_id") / 4).cast("bigint").alias("job"),
                                       (F.col("row_id") % 4).cast("int").alias("rank"), "vec")


def _coll_cells(df):
    return df.select("job", "rank", "pos", C.tidy("x").alias("x"))


@register("coll_broadcast", S.with_(*RANKS_SQL) + f"SELECT rk.job, rk.rank, rc.pos, {S.r('rc.x')} AS x FROM rk "
          "JOIN rc ON rk.job = rc.job AND rc.rank = 0")
def q_coll_broadcast(spark, d):
    b = collectives.broadcast_from(ranks(spark, d), root=0)
    return _coll_cells(b.select("job", "rank", F.posexplode("vec").alias("pos", "x")))


@register("coll_all_reduce", S.with_(*RANKS_SQL, "s AS (SELECT job, pos, sum(x) AS x FROM rc GROUP BY job, pos)")
          + f"SELECT rk.job, rk.rank, s.pos, {S.r('s.x')} AS x FROM rk JOIN s ON rk.job = s.job")
def q_coll_all_reduce(spark, d):
    return _coll_cells(collectives.all_reduce(ranks(spark, d)))


@register("coll_gather", S.with_(*RANKS_SQL) + f"SELECT job, 0 AS rank, rank * 64 + pos AS pos, {S.r('x')} AS x FROM rc")
def q_coll_gather(spark, d):
    return _coll_cells(collectives.gather(ranks(spark, d), root=0, width=64))


@register("coll_reduce_scatter", S.with_(*RANKS_SQL)
          + f"SELECT job, CAST(pos // 16 AS INTEGER) AS rank, CAST(pos % 16 AS INTEGER) AS pos, {S.r('sum(x)')} AS x "
          "FROM rc GROUP BY job, pos")
def q_coll_reduce_scatter(spark, d):
    return _coll_cells(collectives.reduce_scatter(ranks(spark, d), world=4, width=64))


# ================================================================ sources and sinks
def kv_table(spark, d, byte_order: str = "little") -> DataFrame:
    """embeddings written as a key-value sample table: key, LE tensor blob [8, 8], BE int32 label."""
    rows = D.emb_rows(spark, d)
    enc = blobs.encode(rows.select("row_id", "vec", "label"), "vec", (8, 8), "image", True, byte_order)
    return enc.select(kv.row_key("row_id").alias("row_key"), "image", kv.encode_be_int32("label").alias("label"))


@register("blob_roundtrip", S.with_(S.EMB) + f"SELECT row_id, j, {S.r('x')} AS v, 2 AS ndim, true AS requires_grad "
          "FROM emb")
def q_blob_roundtrip(spark, d):
    rows = D.emb_rows(spark, d).select("row_id", "vec")
    dec = blobs.decode(blobs.encode(rows, "vec", (8, 8)), "blob")
    return cells(dec.select("row_id", "data", F.size("shape").alias("ndim"), "requires_grad"),
                 ["row_id", "ndim", "requires_grad"], "data")


@register("blob_roundtrip_be", S.with_(S.EMB) + f"SELECT row_id, j, {S.r('x')} AS v, 2 AS ndim, false AS requires_grad "
          "FROM emb")
def q_blob_roundtrip_be(spark, d):
    rows = D.emb_rows(spark, d).select("row_id", "vec")
    dec = blobs.decode(blobs.encode(rows, "vec", (8, 8), byte_order="big"), "blob", byte_order="big")
    return cells(dec.select("row_id", "data", F.size("shape").alias("ndim"), "requires_grad"),
                 ["row_id", "ndim", "requires_grad"], "data")


@register("label_decode", "SELECT event_id, CAST(floor(value * 100) AS INTEGER) - 25000 AS label FROM events")
def q_label_decode(spark, d):
    ev = D.table(spark, d, "events").select("event_id", (F.floor(F.col("value") * 100).cast("int") - 25000).alias("x"))
    return ev.select("event_id", kv.decode_be_int32(kv.encode_be_int32("x")).alias("label"))


@register("row_key", "SELECT o_orderkey, printf('train_%05d', o_orderkey) AS row_key FROM orders")
def q_row_key(spark, d):
    return D.table(spark, d, "orders").select("o_orderkey", kv.row_key("o_orderkey").alias("row_key"))


PIX_SQL = "least(greatest(CAST(floor((x + 1.0) * 127.5) AS INTEGER), 0), 255)"


def pixels(vec) -> "F.Column":
    """Quantise [-1, 1] values to uint8 pixels (the inverse of ``scale_pixels`` up to rounding)."""
    return F.transform(vec, lambda x: F.least(F.greatest(F.floor((x + 1.0) * 127.5).cast("int"), F.lit(0)), F.lit(255)))


@register("scale_pixels", S.with_(S.EMB) + f"SELECT row_id, j, {S.r(PIX_SQL + ' / 255.0')} AS v FROM emb")
def q_scale_pixels(spark, d):
    px = D.emb_rows(spark, d).select("row_id", pixels("vec").alias("px"))
    return cells(px.select("row_id", F.transform("px", lambda p: p / F.lit(255.0)).alias("s")), ["row_id"], "s")


@register("kv_samples", S.with_(S.EMB) + f"SELECT printf('train_%05d', row_id) AS row_key, label AS label_idx, j, "
          f"{S.r('x')} AS v FROM emb")
def q_kv_samples(spark, d):
    s = kv.scan_samples(kv_table(spark, d))
    return cells(s.select("row_key", C.argmax("target").alias("label_idx"), "features"),
                 ["row_key", "label_idx"], "features")


@register("kv_missing_report", "SELECT count(*) FILTER (WHERE d.doc_id IS NULL) AS missing_image, "
          "count(*) FILTER (WHERE l.doc_id IS NULL) AS missing_label, "
          "count(*) FILTER (WHERE d.doc_id IS NULL OR l.doc_id IS NULL) AS missing_any, count(*) AS rows "
          "FROM documents d FULL OUTER JOIN labels l ON d.doc_id = l.doc_id")
def q_kv_missing_report(spark, d):
    """documents (image bytes) full-outer-joined with labels: the key-value rows lacking either column."""
    docs = D.table(spark, d, "documents").select("doc_id", F.encode("text", "UTF-8").alias("image"))
    labs = D.table(spark, d, "labels").select("doc_id", kv.encode_be_int32("quality").alias("label"))
    j = docs.join(labs, "doc_id", "full_outer")
    return kv.missing_report(j)


@register("kv_upsert", "WITH u AS (SELECT printf('train_%05d', vec_id) AS row_key, 0 AS version, label FROM embeddings "
          "UNION ALL SELECT printf('train_%05d', event_id), 1, CAST(user_id % 10 AS INTEGER) FROM events) "
          "SELECT row_key, max(version) AS version, arg_max(label, version) AS label FROM u GROUP BY row_key")
def q_kv_upsert(spark, d):
    old = D.table(spark, d, "embeddings").select(kv.row_key("vec_id").alias("row_key"), F.lit(0).alias("version"),
                                                 "label")
    new = D.table(spark, d, "events").select(kv.row_key("event_id").alias("row_key"), F.lit(1).alias("version"),
                                             (F.col("user_id") % 10).cast("int").alias("label"))
    return kv.upsert(old, new)


@register("idx_pairing", S.with_(S.EMB) + f"SELECT CAST(row_id // 128 AS VARCHAR) AS shard, row_id % 128 AS idx, "
          f"label, CAST(sum({PIX_SQL}) AS BIGINT) AS pixel_sum FROM emb GROUP BY row_id, label")
def q_idx_pairing(spark, d):
    """embeddings -> uint8 8x8 images -> gzip IDX shards of 128 -> parsed back and paired by (shard, idx)."""
    rows = D.emb_rows(spark, d).select(
        (F.col("row_id") / 128).cast("bigint").alias("shard"), (F.col("row_id") % 128).alias("idx"),
        pixel_bytes(pixels("vec")).alias("pixels"), "label")
    files = idx.idx_shard_files(rows, "shard", "idx", "pixels", "label", 8, 8)
    paired = idx.pair_images_labels(idx.parse_files(files))
    return paired.select("shard", "idx", "label", byte_sum("pixels").alias("pixel_sum"))


def pixel_bytes(px) -> "F.Column":
    """ARRAY<INT> of 0..255 -> BINARY, one byte per pixel."""
    return F.unhex(F.array_join(F.transform(px, lambda p: F.lpad(F.hex(p), 2, "0")), ""))


def byte_sum(b: str) -> "F.Column":
    """Sum of the unsigned bytes of a BINARY column."""
    return F.expr(f"aggregate(sequence(0, length(`{b}`) - 1), 0L, (acc, i) -> acc + "
                  f"cast(conv(substring(hex(`{b}`), i * 2 + 1, 2), 16, 10) as bigint))")


def loss_log_files(spark, d) -> DataFrame:
    """A UTF-16 training log derived from events: one file per 1000 event ids, lines in event order."""
    ev = D.table(spark, d, "events").select("event_id", losslog.format_line(
        (F.col("user_id") % 4).cast("int"), F.abs("value")).alias("line"))
    files = (ev.groupBy((F.col("event_id") / 1000).cast("bigint").alias("f"))
             .agg(F.array_sort(F.collect_list(F.struct("event_id", "line"))).alias("_l")))
    return files.select(F.format_string("log-%06d.txt", "f").alias("path"),
                        F.encode(F.array_join(F.transform("_l", lambda s: s["line"]), "\n"), "UTF-16").alias("content"))


@register("loss_log_curve", "SELECT CAST(user_id % 4 AS INTEGER) AS part, CAST(row_number() OVER (PARTITION BY "
          f"user_id % 4 ORDER BY event_id) AS INTEGER) AS step, {S.r('abs(value)')} AS loss FROM events")
def q_loss_log_curve(spark, d):
    c = losslog.curve(losslog.parse(losslog.lines_from_files(loss_log_files(spark, d), "UTF-16")))
    return c.select("part", "step", C.tidy("loss").alias("loss"))


@register("loss_series", "WITH c AS (SELECT CAST(user_id % 4 AS INTEGER) AS part, row_number() OVER (PARTITION BY "
          "user_id % 4 ORDER BY event_id) AS step, abs(value) AS loss FROM events) SELECT part, "
          f"CAST(count(*) AS INTEGER) AS steps, {S.r('arg_min(loss, step)')} AS first_loss, "
          f"{S.r('arg_max(loss, step)')} AS last_loss, {S.r('min(loss)')} AS min_loss, {S.r('max(loss)')} AS max_loss, "
          f"{S.r('avg(loss)')} AS mean_loss FROM c GROUP BY part")
def q_loss_series(spark, d):
    c = losslog.curve(losslog.parse(losslog.lines_from_files(loss_log_files(spark, d), "UTF-16")))
    s = losslog.series_summary(c)
    return s.select("part", "steps", *[C.tidy(k).alias(k) for k in
                                       ("first_loss", "last_loss", "min_loss", "max_loss", "mean_loss")])

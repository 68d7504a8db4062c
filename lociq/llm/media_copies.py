"""Cropped and edited copies in a column of images, by local descriptors.

Corners are found on several scales (minimum of the structure tensor's eigenvalues; the strongest of each grid cell, so their number
grows with the picture), oriented by the intensity centroid of their patch, and described by 256 comparisons of smoothed points
turned by that angle. A table entry joins 18 bits of a corner's descriptor, 18 bits of a near corner's, and the coarse
angles between the two: two patches make entries of unrelated pictures differ. Pictures that share two entries are verified by
geometric consensus: enough matches must agree on one shift, turn and scale. Entries of many pictures are not expanded into pairs but
linked as lists (`link_lists`); a pair met there is compared on the same condition. Equal images are one class from the start.

Images are binary PGM or PPM (P5, P6; 8 bits). Anything else has no features and is a copy only of equal bytes.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.llm.common import join_checked, pick, small_batches, stored
from lociq.llm.graph import PART_ROWS, link_lists
from lociq.operators.graph import components

SCALES = (1.0, 0.8, 0.64, 0.51, 0.41)
#: Pixels of a grid cell's side; each cell gives its strongest corner.
CELL = 15
RADIUS = 9
#: Near corners that a corner is joined with, and tables of joined bits.
NEAR, TABLES, BITS, SECTORS = 3, 2, 18, 8
#: Entries that a pair must share, and pictures with an entry up to which all their pairs are counted. Chance makes lists that grow with the
#: table (17 pictures of 51,282 at most), and counting a pair costs far less than comparing it.
SHARED, FULL = 2, 128
#: Bits in which matching descriptors may differ, pixels by which matches may miss the common motion, and matches needed.
MATCH_BITS, MISS, AGREE = 56, 3.0, 6
#: Pixels of pictures of one shape that are described together.
TOGETHER = 1 << 16
#: Pixels after which the pictures read so far are described.
READ = 1 << 20
#: Matches that a motion is derived from; all matches are counted for it.
MOTIONS = 512
_RNG = np.random.default_rng(11)
# A patch is brightest on its right once it is turned, so only points one above the other make fair bits.
_POINTS = np.clip(_RNG.normal(0, RADIUS / 2.0, (256, 2, 2)), -RADIUS + 1, RADIUS - 1)
_POINTS[:, 1, 0] = np.clip(_POINTS[:, 0, 0] + _RNG.uniform(-1.5, 1.5, 256), -RADIUS + 1, RADIUS - 1)
_PICKED = np.stack([_RNG.choice(256, 2 * BITS, replace=False) for _ in range(TABLES)])
_GRID = np.stack(np.meshgrid(np.arange(-RADIUS, RADIUS + 1), np.arange(-RADIUS, RADIUS + 1)), axis=-1).reshape(-1, 2)
_DISC = _GRID[(_GRID**2).sum(axis=1) <= RADIUS**2]
_HEADER = re.compile(rb"P([56])(?:\s|#[^\n]*\n)+(\d+)(?:\s|#[^\n]*\n)+(\d+)(?:\s|#[^\n]*\n)+(\d+)\s")
_FEATURE = np.dtype([("x", "<f4"), ("y", "<f4"), ("scale", "<f2"), ("angle", "<f2"), ("bits", "<u8", 4)])


def read_image(raw: bytes | None) -> np.ndarray | None:
    m = _HEADER.match(raw or b"")
    if not m:
        return None
    width, height, depth = int(m[2]), int(m[3]), 3 if m[1] == b"6" else 1
    data = np.frombuffer(raw, np.uint8, offset=m.end())
    if int(m[4]) > 255 or width * height * depth == 0 or len(data) < width * height * depth:
        return None
    data = data[: width * height * depth].astype(np.float64).reshape(height, width, depth)
    return data.mean(axis=2) if depth > 1 else data[..., 0]


def _padded(a: np.ndarray, r: int) -> np.ndarray:
    """Pictures (the last two axes) with r more pixels on each side, edges repeated."""
    return np.pad(a, [(0, 0)] * (a.ndim - 2) + [(r, r)] * 2, mode="edge")


def _box(a: np.ndarray, r: int) -> np.ndarray:
    """Mean over a square of 2r + 1 pixels of pictures (the last two axes), edges repeated. Each is added up in the same order, wherever it lies."""
    k = 2 * r + 1
    h, w = a.shape[-2:]
    p = _padded(a, r)
    rows = p[..., :h, :] + p[..., 1 : h + 1, :] if r else p.copy()
    for d in range(2, k):
        rows += p[..., d : d + h, :]
    out = rows[..., :w] + rows[..., 1 : w + 1] if r else rows
    for d in range(2, k):
        out += rows[..., d : d + w]
    out /= k**2
    return out


def _resized(a: np.ndarray, scale: float) -> np.ndarray:
    if scale == 1:
        return a
    high, wide = a.shape[-2:]
    h, w = max(1, round(high * scale)), max(1, round(wide * scale))
    y, x = (np.arange(h) + 0.5) / scale - 0.5, (np.arange(w) + 0.5) / scale - 0.5
    y0, x0 = np.clip(y.astype(int), 0, high - 1), np.clip(x.astype(int), 0, wide - 1)
    y1, x1 = np.minimum(y0 + 1, high - 1), np.minimum(x0 + 1, wide - 1)
    fy, fx = np.clip(y - y0, 0, 1)[:, None], np.clip(x - x0, 0, 1)
    a = _box(a, 1)
    a = a[..., y0, :] * (1 - fy) + a[..., y1, :] * fy
    return a[..., x0] * (1 - fx) + a[..., x1] * fx


def _highest(a: np.ndarray, r: int) -> np.ndarray:
    """The largest value within r pixels along both axes; nothing lies beyond the edges."""
    for axis in (-2, -1):
        best = a.copy()
        one, two = np.moveaxis(a, axis, -1), np.moveaxis(best, axis, -1)
        for d in range(1, r + 1):
            np.maximum(two[..., d:], one[..., :-d], out=two[..., d:])
            np.maximum(two[..., :-d], one[..., d:], out=two[..., :-d])
        a = best
    return a


def _features(images: np.ndarray, cell: int) -> list[np.ndarray]:
    """Features of pictures of one shape."""
    found: list[list[np.ndarray]] = [[] for _ in images]
    reach = int(np.ceil(np.hypot(*(np.abs(_POINTS).max(axis=(0, 1)))))) + 1  # how far a turned point may lie beyond the edge
    for scale in SCALES:
        a = _resized(images, scale)
        if min(a.shape[1:]) <= 2 * RADIUS + 2:
            break
        gy, gx = np.gradient(_box(a, 1), axis=(1, 2))
        xx, yy, xy = _box(gx * gx, 2), _box(gy * gy, 2), _box(gx * gy, 2)
        strength = (xx + yy) / 2 - np.sqrt(((xx - yy) / 2) ** 2 + xy**2)
        inner = np.zeros_like(strength)
        inner[:, RADIUS:-RADIUS, RADIUS:-RADIUS] = strength[:, RADIUS:-RADIUS, RADIUS:-RADIUS]
        t, y, x = np.nonzero((inner == _highest(inner, 2)) & (inner > 1.0))  # maxima within two pixels
        order = np.lexsort((x, y, -inner[t, y, x], t))
        t, y, x = t[order], y[order], x[order]
        down, across = a.shape[1] // cell + 1, a.shape[2] // cell + 1
        _, first = np.unique((t * down + y // cell) * across + x // cell, return_index=True)
        t, y, x = t[first], y[first], x[first]
        if not len(y):
            continue
        wide = a.shape[2]
        patch = a.reshape(-1)[((t * a.shape[1] + y) * wide + x)[:, None] + (_DISC[:, 1] * wide + _DISC[:, 0])]
        patch -= patch.mean(axis=1, keepdims=True)
        angle = np.arctan2(patch @ _DISC[:, 1].astype(np.float64), patch @ _DISC[:, 0].astype(np.float64))
        c, s = np.cos(angle)[:, None], np.sin(angle)[:, None]
        smooth = _padded(_box(a, 2), reach)
        high, wide = smooth.shape[1:]
        at = ((t * high + y + reach) * wide + x + reach)[:, None]
        values = []
        for qx, qy in (_POINTS[:, 0].T, _POINTS[:, 1].T):  # the two points that are compared
            px, py = np.rint(qx * c - qy * s), np.rint(qx * s + qy * c)
            py *= wide
            py += px
            values.append(smooth.reshape(-1)[at + py.astype(np.int64)])
        out = np.zeros(len(y), _FEATURE)
        out["x"], out["y"], out["scale"], out["angle"] = x / scale, y / scale, 1 / scale, angle
        out["bits"] = np.packbits(values[0] < values[1], axis=1).view("<u8")
        for k, part in enumerate(np.split(out, np.searchsorted(t, np.arange(1, len(images))))):
            found[k].append(part)
    return [np.concatenate(f) if f else np.zeros(0, _FEATURE) for f in found]


def describe_all(images: list[np.ndarray], cell: int = CELL) -> list[np.ndarray]:
    """Features of each image: for each scale the strongest corner of each cell. Pictures of one shape go together, up to TOGETHER pixels of them."""
    shapes: dict[tuple[int, ...], list[int]] = {}
    for k, image in enumerate(images):
        shapes.setdefault(image.shape, []).append(k)
    found: list[np.ndarray] = [np.zeros(0, _FEATURE)] * len(images)
    for (h, w), at in shapes.items():
        step = max(1, TOGETHER // (h * w))
        for a in range(0, len(at), step):
            for k, f in zip(at[a : a + step], _features(np.stack([images[k] for k in at[a : a + step]]), cell), strict=True):
                found[k] = f
    return found


def describe(image: np.ndarray, cell: int = CELL) -> np.ndarray:
    """Features of one image: for each scale the strongest corner of each cell."""
    return describe_all([image], cell)[0]


def _nearest_bits(f: np.ndarray, g: np.ndarray, rows: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each descriptor of f the nearest one of g and the bits in which they differ; for each of g the nearest one of f."""
    j, d = np.zeros(len(f), np.int64), np.zeros(len(f), np.int64)
    back, least = np.zeros(len(g), np.int64), np.full(len(g), 1 << 30)
    for a in range(0, len(f), rows):
        apart = np.bitwise_count(f["bits"][a : a + rows, None] ^ g["bits"][None]).sum(axis=2, dtype=np.int16)
        j[a : a + rows] = apart.argmin(axis=1)
        d[a : a + rows] = apart.min(axis=1)
        best = apart.min(axis=0)
        back = np.where(best < least, a + apart.argmin(axis=0), back)
        least = np.minimum(least, best)
    return j, d, back


def agreeing(f: np.ndarray, g: np.ndarray) -> int:
    """The largest number of one-to-one matches that one shift, turn and scale explains."""
    if not len(f) or not len(g):
        return 0
    i = np.arange(len(f))
    j, apart, back = _nearest_bits(f, g)
    mutual = (back[j] == i) & (apart <= MATCH_BITS)  # each is the other's nearest
    i, j = i[mutual], j[mutual]
    if len(i) < AGREE:
        return len(i)
    f, g = f[i], g[j]
    fx, fy, gx, gy = (h[c].astype(np.float64) for h in (f, g) for c in ("x", "y"))
    start = np.argsort(apart[i], kind="stable")[:MOTIONS]  # the closest matches propose the motions
    grow = g["scale"].astype(np.float64)[start] / f["scale"].astype(np.float64)[start]
    turn = g["angle"].astype(np.float64)[start] - f["angle"].astype(np.float64)[start]
    c, s = grow * np.cos(turn), grow * np.sin(turn)
    tx = gx[start] - (c * fx[start] - s * fy[start])
    ty = gy[start] - (s * fx[start] + c * fy[start])
    dx = c[:, None] * fx - s[:, None] * fy + tx[:, None] - gx
    dy = s[:, None] * fx + c[:, None] * fy + ty[:, None] - gy
    near = dx * dx + dy * dy <= (MISS * np.maximum(1, grow)[:, None]) ** 2
    best = near[near.sum(axis=1).argmax()]
    places = lambda x, y: len({(round(float(p) / 3), round(float(q) / 3)) for p, q in zip(x[best], y[best], strict=True)})
    return min(places(fx, fy), places(gx, gy))


def table_keys(f: np.ndarray, near: int = NEAR) -> np.ndarray:
    """The distinct table entries of an image: bits of a corner and of one of its nearest corners of the same scale, and the sectors of the
    direction between them and of their turn, both as seen from the first corner."""
    out = []
    bits = np.unpackbits(np.ascontiguousarray(f["bits"]).view(np.uint8).reshape(len(f), 32), axis=1)[:, _PICKED].astype(np.int64)  # (n, tables, 32)
    half = [bits[:, :, k * BITS : (k + 1) * BITS] @ (1 << np.arange(BITS)) for k in (0, 1)]
    sector = lambda angle: np.floor((angle / (2 * np.pi)) % 1.0 * SECTORS).astype(np.int64) % SECTORS
    for scale in np.unique(f["scale"]):
        at = np.flatnonzero(f["scale"] == scale)
        if len(at) < 2:
            continue
        x, y, angle = (f[c][at].astype(np.float64) for c in ("x", "y", "angle"))
        for a in range(0, len(at), 256):
            part = slice(a, a + 256)
            far = (x[part, None] - x) ** 2 + (y[part, None] - y) ** 2
            far[np.arange(len(far)), a + np.arange(len(far))] = np.inf
            k = min(near, len(at) - 1)
            other = np.argsort(far, axis=1, kind="stable")[:, :k]
            one = np.repeat(np.arange(a, a + len(far)), k)
            two = other.ravel()
            way = sector(np.arctan2(y[two] - y[one], x[two] - x[one]) - angle[one])
            turn = sector(angle[two] - angle[one] + np.pi / SECTORS)
            code = (way * SECTORS + turn)[:, None] * TABLES + np.arange(TABLES)
            out.append(((code << 2 * BITS) | (half[0][at[one]] << BITS) | half[1][at[two]]).ravel())
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each image, and the features where this task meets it first."""
    seen: set[bytes] = set()
    for batch in batches:
        found: list[bytes | None] = []
        rows, images, pixels = [], [], 0

        def describe_read() -> None:
            for row, f in zip(rows, describe_all(images), strict=True):  # noqa: B023
                found[row] = f.tobytes()  # noqa: B023

        for digest, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            new = raw is not None and digest not in seen
            seen.add(digest)
            image = read_image(raw) if new else None
            found.append(b"" if new else None)
            if image is not None:
                rows, images, pixels = [*rows, len(found) - 1], [*images, image], pixels + image.size
            if pixels >= READ:
                describe_read()
                rows, images, pixels = [], [], 0
        describe_read()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["media_id", "digest", "features"])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [table_keys(np.frombuffer(f, _FEATURE)) for f in batch.column(1).to_pylist()]
        rows = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys) if keys else [], pa.int64()), batch.column(0).take(pa.array(rows, pa.int64()))], names=["token", "cls"])


def _consensus(batches: Iterator[pa.RecordBatch], agree: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        f, g = ([np.frombuffer(x, _FEATURE) for x in batch.column(c).to_pylist()] for c in ("x", "y"))
        ok = [agreeing(p, q) >= agree for p, q in zip(f, g, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _verified(pairs: DataFrame, features: DataFrame, agree: int) -> DataFrame:
    wanted = stored(pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct(), "media-wanted")
    some = join_checked(features, wanted, "cls", "left_semi")
    left = some.select(F.col("cls").alias("a"), F.col("features").alias("x"))
    right = some.select(F.col("cls").alias("b"), F.col("features").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(partial(_consensus, agree=agree), "a long, b long")


def _sharing(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs whose pictures share enough entries: those of each are in held (cls, tokens)."""
    one, two = (held.select(F.col("cls").alias(c), F.col("tokens").alias(f"tokens_{c}")) for c in ("a", "b"))
    return pairs.join(one, "a").join(two, "b").where(F.size(F.array_intersect("tokens_a", "tokens_b")) >= SHARED).select("a", "b")


def media_groups(media: DataFrame, agree: int = AGREE) -> DataFrame:
    """media_id, n_features, class_id, group_id of every row of media (media_id, image).

    class_id is the smallest media_id with the same bytes, group_id the smallest that verified copies reach. A null image has no
    features and is alone. Null ids stay null. Repeated rows are rows of their own; an empty table gives an empty result; other columns
    are ignored. Images are read once and never shuffled, only their features are.
    """
    small_batches(media.sparkSession, 256)
    rows = pick(media, media_id="long", image="binary").select("media_id", F.unhex(F.md5("image")).alias("digest"), "image")
    described = rows.mapInArrow(_described, "media_id long, digest binary, features binary").withColumn("cls", F.monotonically_increasing_id())
    described = stored(described, "media-described")
    # a class is named by one of its rows that have features; other tasks may have described it too
    known = described.where("digest IS NOT NULL").select("media_id", "digest", F.when(F.col("features").isNotNull(), F.col("cls")).alias("cls"), F.octet_length("features").alias("bytes"))
    classes = stored(known.groupBy("digest").agg(F.min("media_id").alias("class_id"), F.min("cls").alias("cls"), F.max("bytes").alias("bytes")), "media-classes")
    again = known.where("bytes > 0").join(classes.select("digest", F.col("cls").alias("named")), "digest").where("cls <> named").select("cls")
    features = join_checked(described.where(F.octet_length("features") > 0).select("cls", "features"), stored(again, "media-again"), "cls", "left_anti")
    entries = features.mapInArrow(_entries, "token long, cls long")
    posts = entries.withColumn("k", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("k > 1")
    posts = stored(posts.select("token", "k", "cls"), "media-postings")
    check = partial(_verified, features=features, agree=agree)
    short = posts.where(F.col("k") <= FULL).select("token", "cls")
    met = short.withColumnRenamed("cls", "a").join(short.withColumnRenamed("cls", "b"), "token").where("a < b")
    pairs = stored(met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("met")).where(F.col("met") >= SHARED).select("a", "b"), "media-pairs")
    links = stored(check(pairs), "media-links")
    part = F.when(F.col("k") > PART_ROWS, F.pmod(F.xxhash64("cls"), F.ceil(F.col("k") / PART_ROWS)) + 1).otherwise(0)
    one = [F.lit(1).alias(c) for c in ("n", "lo", "hi")]  # pictures have no size that tells
    long = posts.where(F.col("k") > FULL).select("token", part.cast("int").alias("salt"), "cls", *one)
    if not long.isEmpty():
        long = stored(long, "media-long-lists")
        held = join_checked(posts, stored(long.select("cls").distinct(), "media-wanted"), "cls", "left_semi").groupBy("cls").agg(F.collect_list("token").alias("tokens"))
        held = stored(held, "media-held")
        more = link_lists(long, lambda met: check(stored(_sharing(met, held), "media-pairs"))).select(F.col("cls").alias("a"), F.col("label").alias("b"))
        links = links.unionByName(more.where("a <> b"))
    roots = components(links).select(F.col("node").alias("cls"), F.col("component").alias("root"))
    named = classes.select("cls", "digest", "class_id", (F.col("bytes") / _FEATURE.itemsize).cast("long").alias("n_features"))
    named = named.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    smallest = named.groupBy("root").agg(F.min("class_id").alias("group_id"))
    named = stored(named.join(smallest, "root").select("digest", "class_id", "group_id", "n_features"), "media-groups")
    out = described.select("media_id", "digest").join(named, "digest", "left")
    return out.select("media_id", F.coalesce("n_features", F.lit(0)).alias("n_features"), F.coalesce("class_id", "media_id").alias("class_id"), F.coalesce("group_id", "media_id").alias("group_id"))


# The test tables hold no images; these render a media column from the vectors.


def picture(seed: int, size: int = 96) -> np.ndarray:
    """A deterministic picture: cloudy texture of three grains."""
    rng = np.random.default_rng(seed)
    a = np.zeros((size, size))
    for grain in (3, 6, 12):
        a += _box(np.kron(rng.normal(0, 60, (size // grain, size // grain)), np.ones((grain, grain))), grain // 3)
    return np.clip(a + 128, 0, 255)


def edited(a: np.ndarray, kind: int, seed: int) -> np.ndarray:
    """kind 1: cropped; 2: changed in contrast and brightness, with noise; 3: a quarter turn, cropped; else unchanged."""
    if kind == 1:
        return a[7:85, 11:93]
    if kind == 2:
        return np.clip(a * 0.8 + 30 + np.random.default_rng(seed).normal(0, 2, a.shape), 0, 255)
    return np.rot90(a)[4:92, 6:90] if kind == 3 else a


def as_pgm(a: np.ndarray) -> bytes:
    return b"P5 %d %d 255\n" % (a.shape[1], a.shape[0]) + np.ascontiguousarray(np.rint(a), np.uint8).tobytes()


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            kind = (i or 0) % 8
            seed = (i or 0) - kind if kind < 4 else (1 << 40) + zlib.crc32(np.array([x or 0 for x in v or ()], "<f4").tobytes())
            out.append(as_pgm(edited(picture(seed), kind, i or 0)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["media_id", "image"])


def rendered_media(vectors: DataFrame) -> DataFrame:
    """media_id, image for every row of vectors: of eight ids in a row, the first four are one picture and three edited copies of it;
    the others show their vector, so that equal vectors have equal pictures."""
    small_batches(vectors.sparkSession, 256)
    return pick(vectors, vec_id="long", embedding="array<float>").mapInArrow(_render, "media_id long, image binary")

"""Image-hash queries on ``embeddings``: each 64-float embedding is an 8x8
grey image (pixel (x, y) = element y*8 + x, grey = floor((v + 0.5) * 255)
clamped to 0..255); the colour hash reads it as 21 RGB pixels. A video is
the set of images with one ``label``. Similarity joins use 16-bit average
hashes of 4x4 block means (threshold 2), the multi-hash uses the four 4x4
quadrants as segments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions import imagehash as H
from skein.functions import separable, wide
from skein.functions.bits import hamming64, hamming_hex, hash_bucket
from skein.operators import imaging, widejoin
from skein.plans.registry import query
from skein.sources.tables import Tables

W = 8
T_SIM = 2
BITS16 = 16


def grids(t: Tables) -> DataFrame:
    e = t.embeddings
    return e.select(F.col("vec_id").alias("img"), "label", H.grey_from_unit("embedding").alias("grid"))


def _rgb(grid):
    return H.let(grid, lambda gr: F.transform(F.sequence(F.lit(0), F.lit(20)), lambda j: F.struct(
        F.element_at(gr, j * 3 + 1).alias("r"), F.element_at(gr, j * 3 + 2).alias("g"),
        F.element_at(gr, j * 3 + 3).alias("b"))))


def h16(t: Tables) -> DataFrame:
    g = grids(t)
    return g.select("img", "label", H.average_hash(H.block_mean("grid", W, W, 2)).alias("h"))


# ------------------------------------------------------------------ SQL parts
_G = """px AS (SELECT vec_id, label, unnest(generate_series(0, 63)) AS i, unnest(embedding) AS v FROM embeddings),
  g AS (SELECT vec_id, label, i, least(greatest(floor((v::DOUBLE + 0.5) * 255), 0), 255)::INTEGER AS p FROM px)"""


def _bits(cond: str, order: str) -> str:
    return f"('0b' || string_agg(CASE WHEN {cond} THEN '1' ELSE '0' END, '' ORDER BY {order}))::UBIGINT"


def _hex(u: str, digits: int) -> str:
    return f"lower(lpad(hex({u}), {digits}, '0'))"


_AH = f"""ah AS (SELECT vec_id, {_bits('p > m', 'i')} AS u FROM g JOIN (SELECT vec_id, avg(p) AS m FROM g GROUP BY 1) USING (vec_id) GROUP BY vec_id)"""
_DH = f"""dh AS (SELECT a.vec_id, {_bits('b.p > a.p', 'a.i')} AS u FROM g a JOIN g b ON a.vec_id = b.vec_id AND b.i = a.i + 1
                WHERE a.i % 8 < 7 GROUP BY a.vec_id)"""
_DV = f"""dv AS (SELECT a.vec_id, {_bits('b.p > a.p', 'a.i')} AS u FROM g a JOIN g b ON a.vec_id = b.vec_id AND b.i = a.i + 8
                GROUP BY a.vec_id)"""
_CO = """co AS (SELECT g.vec_id, uu.u, vv.v, sum(p * cos(pi() / 16 * uu.u * (2 * (i // 8) + 1)) * cos(pi() / 16 * vv.v * (2 * (i % 8) + 1))) AS c
                FROM g, range(8) AS uu(u), range(8) AS vv(v) GROUP BY ALL)"""
_PH = f"""ph AS (SELECT vec_id, {_bits('c > med', 'u * 8 + v')} AS u FROM co JOIN (SELECT vec_id, median(c) AS med FROM co GROUP BY 1) USING (vec_id) GROUP BY vec_id)"""
_PS = f"""cs AS (SELECT vec_id, u, v, c * CASE WHEN u = 0 THEN 1 / sqrt(2) ELSE 1 END * CASE WHEN v = 0 THEN 1 / sqrt(2) ELSE 1 END AS c FROM co),
  ps AS (SELECT vec_id, {_bits('c > mn', 'v * 8 + u')} AS u FROM cs JOIN (SELECT vec_id, avg(c) AS mn FROM cs WHERE u + v > 0 GROUP BY 1) USING (vec_id) GROUP BY vec_id)"""
_CR = """cr AS (SELECT g.vec_id, i // 8 AS y, kk.k, sum(p * cos(pi() / 16 * kk.k * (2 * (i % 8) + 1))) AS c
                FROM g, range(1, 8) AS kk(k) GROUP BY ALL)"""
_P1 = f"""p1 AS (SELECT vec_id, {_bits('c > mn', 'y * 8 + k')} AS u FROM cr JOIN (SELECT vec_id, avg(c) AS mn FROM cr GROUP BY 1) USING (vec_id) GROUP BY vec_id)"""
_WH = f"""wh AS (SELECT vec_id, {_bits('p > med', 'i')} AS u FROM g JOIN (SELECT vec_id, median(p) AS med FROM g GROUP BY 1) USING (vec_id) GROUP BY vec_id)"""
_BM = """bm AS (SELECT vec_id, label, ((i // 8) // 2) * 4 + (i % 8) // 2 AS j, avg(p) AS p FROM g GROUP BY ALL),
  h16 AS (SELECT vec_id, label, ('0b' || string_agg(CASE WHEN p > m THEN '1' ELSE '0' END, '' ORDER BY j))::UBIGINT AS h
          FROM bm JOIN (SELECT vec_id, avg(p) AS m FROM bm GROUP BY 1) USING (vec_id) GROUP BY vec_id, label)"""


def _w(*parts: str) -> str:
    return "WITH " + ",\n  ".join(parts) + "\n"


# -------------------------------------------------------------------- queries
@query("average_hash", sql=_w(_G, _AH) + f"SELECT vec_id AS img, {_hex('u', 16)} AS hash FROM ah")
def q_average_hash(spark, sf_dir):
    """average hash (pixel > mean) of each 8x8 image."""
    g = grids(Tables(spark, sf_dir))
    return g.select("img", H.hash_hex(H.average_hash("grid"), 64).alias("hash"))


@query("average_hash_scala", sql=_w(_G) + f""", ai AS (SELECT vec_id, {_bits('p > m', 'i')} AS u FROM g
      JOIN (SELECT vec_id, floor(avg(p)) AS m FROM g GROUP BY 1) USING (vec_id) GROUP BY vec_id)
    SELECT vec_id AS img, {_hex('u', 16)} AS hash FROM ai""")
def q_average_hash_scala(spark, sf_dir):
    """Average hash against the integer mean."""
    g = grids(Tables(spark, sf_dir))
    return g.select("img", H.hash_hex(H.average_hash("grid", "scala"), 64).alias("hash"))


@query("dhash", sql=_w(_G, _DH) + f"SELECT vec_id AS img, {_hex('u', 14)} AS hash FROM dh")
def q_dhash(spark, sf_dir):
    """horizontal difference hash (right neighbour brighter), 56 bits."""
    g = grids(Tables(spark, sf_dir))
    return g.select("img", H.hash_hex(H.dhash("grid", W, W), 56).alias("hash"))


@query("dhash_vertical", sql=_w(_G, _DV) + f"SELECT vec_id AS img, {_hex('u', 14)} AS hash FROM dv")
def q_dhash_vertical(spark, sf_dir):
    """vertical difference hash (pixel below brighter), 56 bits."""
    g = grids(Tables(spark, sf_dir))
    return g.select("img", H.hash_hex(H.dhash_vertical("grid", W, W), 56).alias("hash"))


@query("phash_median", sql=_w(_G, _CO, _PH) + f"SELECT vec_id AS img, {_hex('u', 16)} AS hash FROM ph")
def q_phash_median(spark, sf_dir):
    """DCT hash, coefficients above their median (Python form)."""
    g = grids(Tables(spark, sf_dir))
    return g.select("img", H.hash_hex(H.phash("grid", W, "median"), 64).alias("hash"))


@query("phash", sql=_w(_G, _CO, _PS) + f"SELECT vec_id AS img, {_hex('u', 16)} AS hash FROM ps")
def q_phash(spark, sf_dir):
    """DCT hash, scaled coefficients above the mean without the DC term (Scala form)."""
    g = grids(Tables(spark, sf_dir))
    return g.select("img", H.hash_hex(H.phash("grid", W, "mean_no_dc"), 64).alias("hash"))


@query("phash_simple", sql=_w(_G, _CR, _P1) + f"SELECT vec_id AS img, {_hex('u', 14)} AS hash FROM p1")
def q_phash_simple(spark, sf_dir):
    """simple DCT hash: row DCT, columns 1..7, above their mean."""
    g = grids(Tables(spark, sf_dir))
    return g.select("img", H.hash_hex(H.phash("grid", W, "simple"), 56).alias("hash"))


def grids16(t: Tables) -> DataFrame:
    """16x16 images made of four neighbouring ones (vec_id / 4), two by two; incomplete fours are no image."""
    g = grids(t).withColumn("four", F.floor(F.col("img") / 4).cast("long"))
    parts = g.groupBy("four").agg(F.sort_array(F.collect_list(F.struct((F.col("img") % 4).alias("at"), "grid"))).alias("parts"))
    parts = parts.filter(F.size("parts") == 4)  # four rows of a group at most
    pixel = lambda i: (i / 128).cast("int") * 2 + ((i % 16) / 8).cast("int")
    inner = lambda i: ((i / 16).cast("int") % 8) * 8 + i % 8
    whole = F.transform(F.sequence(F.lit(0), F.lit(255)), lambda i: F.element_at(
        F.element_at(F.col("parts"), pixel(i) + 1)["grid"], inner(i) + 1))
    return parts.select(F.col("four").alias("img"), whole.alias("grid"))


_G16 = """g16 AS (SELECT vec_id // 4 AS img, (vec_id % 4) // 2 * 8 + i // 8 AS y, (vec_id % 4) % 2 * 8 + i % 8 AS x, p FROM g
          WHERE vec_id // 4 IN (SELECT vec_id // 4 FROM embeddings GROUP BY 1 HAVING count(*) = 4))"""


@query("phash_lowfreq", sql=_w(_G, _G16) + f""",
    co AS (SELECT img, uu.u, vv.v, sum(p * cos(pi() / 32 * uu.u * (2 * y + 1)) * cos(pi() / 32 * vv.v * (2 * x + 1))) AS c
           FROM g16, range(8) AS uu(u), range(8) AS vv(v) GROUP BY ALL),
    ph AS (SELECT img, {_bits('c > med', 'u * 8 + v')} AS u FROM co JOIN (SELECT img, median(c) AS med FROM co GROUP BY 1) USING (img) GROUP BY img),
    cs AS (SELECT img, u, v, c * CASE WHEN u = 0 THEN 1 / sqrt(2) ELSE 1 END * CASE WHEN v = 0 THEN 1 / sqrt(2) ELSE 1 END AS c FROM co),
    ps AS (SELECT img, {_bits('c > mn', 'v * 8 + u')} AS u FROM cs JOIN (SELECT img, avg(c) AS mn FROM cs WHERE u + v > 0 GROUP BY 1) USING (img) GROUP BY img),
    cr AS (SELECT img, y, kk.k, sum(p * cos(pi() / 32 * kk.k * (2 * x + 1))) AS c FROM g16, range(1, 9) AS kk(k) WHERE y < 8 GROUP BY ALL),
    p1 AS (SELECT img, {_bits('c > mn', 'y * 8 + k')} AS u FROM cr JOIN (SELECT img, avg(c) AS mn FROM cr GROUP BY 1) USING (img) GROUP BY img)
    SELECT img, {_hex('ph.u', 16)} AS median, {_hex('ps.u', 16)} AS mean, {_hex('p1.u', 16)} AS simple
    FROM ph JOIN ps USING (img) JOIN p1 USING (img)""")
def q_phash_lowfreq(spark, sf_dir):
    """the three DCT hashes of the 8x8 lowest frequencies of 16x16 images."""
    g = grids16(Tables(spark, sf_dir))
    of = lambda mode: H.hash_hex(H.phash("grid", 16, mode, 8), 64)
    return g.select("img", of("median").alias("median"), of("mean_no_dc").alias("mean"), of("simple").alias("simple"))


@query("whash", sql=_w(_G, _WH) + f"SELECT vec_id AS img, {_hex('u', 16)} AS hash FROM wh")
def q_whash(spark, sf_dir):
    """F8: Haar wavelet hash at hash size (value above the median)."""
    g = grids(Tables(spark, sf_dir))
    return g.select("img", H.hash_hex(H.wavelet_hash("grid"), 64).alias("hash"))


def _haar_values(n: int) -> str:
    rows = [f"({j}, {t}, {w!r})" for j, row in enumerate(H.haar_basis(n)) for t, w in enumerate(row) if w != 0]
    return "haar(j, t, w) AS (VALUES " + ", ".join(rows) + ")"


_HR = f"""{_haar_values(W)},
  hc AS (SELECT vec_id, j, sum(p * w::DOUBLE) AS c FROM g JOIN haar ON g.i = haar.t GROUP BY ALL),
  hh AS (SELECT vec_id, {_bits('c > mn', 'j')} AS u FROM hc
         JOIN (SELECT vec_id, avg(c) AS mn FROM hc WHERE j > 0 GROUP BY 1) USING (vec_id) GROUP BY vec_id)"""


@query("whash_haar", sql=_w(_G, _HR) + f"SELECT vec_id AS img, {_hex('u', 16)} AS hash FROM hh")
def q_whash_haar(spark, sf_dir):
    """F8 (Scala form, Q23): full Haar pyramid of the 8x8 grid against the mean without DC."""
    g = grids(Tables(spark, sf_dir))
    return g.select("img", H.hash_hex(H.haar_hash("grid", W), 64).alias("hash"))


_COLOR_SQL = _w(_G) + """,
  rgb AS (SELECT vec_id, i // 3 AS j, max(p) FILTER (WHERE i % 3 = 0) AS r, max(p) FILTER (WHERE i % 3 = 1) AS gg,
                 max(p) FILTER (WHERE i % 3 = 2) AS b FROM g WHERE i < 63 GROUP BY vec_id, i // 3),
  hsv0 AS (SELECT vec_id, j, r, gg, b, greatest(r, gg, b)::DOUBLE AS mx, least(r, gg, b)::DOUBLE AS mn FROM rgb),
  hsv AS (SELECT *, CASE WHEN mx - mn = 0 THEN 0.0 WHEN mx = r THEN (gg - b) / (mx - mn)
                         WHEN mx = gg THEN (b - r) / (mx - mn) + 2.0 ELSE (r - gg) / (mx - mn) + 4.0 END AS hue6 FROM hsv0),
  hsv2 AS (SELECT vec_id, j,
      floor((CASE WHEN hue6 < 0 THEN hue6 + 6.0 ELSE hue6 END) / 6.0 * 255.0) AS h,
      floor(CASE WHEN mx = 0 THEN 0.0 ELSE (mx - mn) / mx * 255.0 END) AS s,
      floor((r * 299 + gg * 587 + b * 114) / 1000.0 + 0.5) AS lum FROM hsv),
  cls AS (SELECT vec_id, CASE WHEN lum < 32 THEN 0 WHEN s < 85 THEN 1
                              WHEN s < 170 THEN 2 + least(floor(h / 42.5), 5)
                              WHEN s > 170 THEN 8 + least(floor(h / 42.5), 5) ELSE -1 END AS c FROM hsv2),
  cnt AS (SELECT e.vec_id, k.k, count(c.c) FILTER (WHERE c.c = k.k) AS n FROM embeddings e CROSS JOIN range(14) AS k(k)
          LEFT JOIN cls c ON c.vec_id = e.vec_id GROUP BY ALL),
  tot AS (SELECT vec_id, greatest(count(*) FILTER (WHERE c >= 2), 1) AS cc FROM cls GROUP BY vec_id),
  vals AS (SELECT vec_id, k, least(7, floor(CASE WHEN k < 2 THEN n * 8 / 21.0 ELSE n * 8 / cc::DOUBLE END)) AS v
           FROM cnt JOIN tot USING (vec_id)),
  bitsx AS (SELECT vec_id, k, bb.i, CASE bb.i WHEN 0 THEN (floor(v / 4) % 8) > 0 WHEN 1 THEN (floor(v / 2) % 4) > 0
                                             ELSE (v % 2) > 0 END AS bit FROM vals, range(3) AS bb(i))
SELECT vec_id AS img, lower(lpad(hex(('0b' || string_agg(CASE WHEN bit THEN '1' ELSE '0' END, '' ORDER BY k, i))::UBIGINT), 11, '0')) AS hash
FROM bitsx GROUP BY vec_id"""


@query("color_hash", sql=_COLOR_SQL)
def q_color_hash(spark, sf_dir):
    """Colour hash of the 21 RGB pixels of each embedding (42 bits)."""
    g = grids(Tables(spark, sf_dir))
    return g.select("img", H.hash_hex(H.color_hash(_rgb(F.col("grid"))), 42).alias("hash"))


_NEXT = "JOIN ah b ON b.vec_id = a.vec_id + 1"


@query("hamming", sql=_w(_G, _AH) + f"""SELECT a.vec_id AS img, b.vec_id AS other, bit_count(xor(a.u, b.u))::INTEGER AS dist
    FROM ah a {_NEXT}""")
def q_hamming(spark, sf_dir):
    """bit distance between the average hashes of consecutive images."""
    g = grids(Tables(spark, sf_dir)).select("img", H.average_hash("grid").alias("h"))
    b = g.select((F.col("img") - 1).alias("img"), F.col("img").alias("other"), F.col("h").alias("h2"))
    return g.join(b, "img").select("img", "other", hamming64("h", "h2").alias("dist"))


@query("hamming_hex", sql=_w(_G, _AH) + f"""SELECT a.vec_id AS img, b.vec_id AS other,
    len(list_filter(range(1, 17), lambda k: substr({_hex('a.u', 16)}, k, 1) <> substr({_hex('b.u', 16)}, k, 1)))::INTEGER AS dist
    FROM ah a {_NEXT}""")
def q_hamming_hex(spark, sf_dir):
    """Distance as the number of unequal hex digits."""
    g = grids(Tables(spark, sf_dir)).select("img", H.hash_hex(H.average_hash("grid"), 64).alias("x"))
    b = g.select((F.col("img") - 1).alias("img"), F.col("img").alias("other"), F.col("x").alias("x2"))
    return g.join(b, "img").select("img", "other", hamming_hex("x", "x2").alias("dist"))


@query("hash_hex", sql=_w(_G, _AH) + f"""SELECT vec_id AS img, {_hex('u', 16)} AS hash,
    (u::HUGEINT - CASE WHEN u >= 9223372036854775808 THEN 18446744073709551616 ELSE 0 END)::BIGINT AS value FROM ah""")
def q_hash_hex(spark, sf_dir):
    """hex text <-> signed 64-bit value (round trip through the text)."""
    g = grids(Tables(spark, sf_dir)).select("img", H.hash_hex(H.average_hash("grid"), 64).alias("hash"))
    return g.select("img", "hash", H.hex_to_hash("hash").alias("value"))


@query("hash_bucket", sql=_w(_G) + """SELECT vec_id AS img, sum(CASE WHEN p > m THEN 1 << (i % 8) ELSE 0 END)::BIGINT AS bucket
    FROM g JOIN (SELECT vec_id, avg(p) AS m FROM g GROUP BY 1) USING (vec_id) GROUP BY vec_id""")
def q_hash_bucket(spark, sf_dir):
    """short bucket key of the average hash."""
    g = grids(Tables(spark, sf_dir))
    return g.select("img", hash_bucket(H.average_hash("grid")).alias("bucket"))


@query("all_hashes", sql=_w(_G, _AH, _DH, _DV, _CO, _PH, _WH) + f"""
    SELECT vec_id AS img, 'ahash' AS algorithm, {_hex('u', 16)} AS hash FROM ah
    UNION ALL SELECT vec_id, 'dhash', {_hex('u', 14)} FROM dh
    UNION ALL SELECT vec_id, 'dhash_vertical', {_hex('u', 14)} FROM dv
    UNION ALL SELECT vec_id, 'phash', {_hex('u', 16)} FROM ph
    UNION ALL SELECT vec_id, 'whash', {_hex('u', 16)} FROM wh""")
def q_all_hashes(spark, sf_dir):
    """all hashes per image, long form (algorithm, hash)."""
    wide = imaging.hash_rows(grids(Tables(spark, sf_dir)), W, W)
    return imaging.hashes_long(wide, ["ahash", "dhash", "dhash_vertical", "phash", "whash"])


def _frames(t):
    return h16(t).select(F.col("label").alias("video"), F.col("img").alias("frame"), "h")


@query("hamming_join", sql=_w(_G, _BM) + f"""
    SELECT DISTINCT a.label AS video, a.vec_id AS frame, b.label AS other_video
    FROM h16 a JOIN h16 b ON a.label <> b.label AND bit_count(xor(a.h, b.h)) <= {T_SIM}""")
def q_hamming_join(spark, sf_dir):
    """Frames that have a similar frame (<= 2 bits) in another video (banded, exact)."""
    return imaging.hamming_semi(_frames(Tables(spark, sf_dir)), BITS16, T_SIM)


@query("video_similarity", sql=_w(_G, _BM) + f""",
  m AS (SELECT DISTINCT a.label AS video, a.vec_id AS frame, b.label AS other_video
        FROM h16 a JOIN h16 b ON a.label <> b.label AND bit_count(xor(a.h, b.h)) <= {T_SIM}),
  n AS (SELECT label, count(*) AS n FROM h16 GROUP BY label)
    SELECT m.video, m.other_video, count(*) AS matched,
           round(count(*) / least(any_value(na.n), any_value(nb.n)), 6) AS similarity
    FROM m JOIN n na ON na.label = m.video JOIN n nb ON nb.label = m.other_video GROUP BY m.video, m.other_video""")
def q_video_similarity(spark, sf_dir):
    """Matched frames / min(frame counts) per pair of videos."""
    v = imaging.video_similarity(_frames(Tables(spark, sf_dir)), BITS16, T_SIM)
    return v.withColumn("similarity", F.round("similarity", 6))


def quadrant_segments(t: Tables) -> DataFrame:
    g = grids(t)
    def quadrant(gr, q: int):
        return F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.element_at(
            gr, (((q // 2) * 4 + (k / 4).cast("int")) * 8 + (q % 2) * 4 + k % 4) + 1))

    quads = H.let(F.col("grid"), lambda gr: F.array(*[quadrant(gr, q) for q in range(4)]))
    s = g.select("img", F.posexplode(quads).alias("seg", "qgrid"))
    return s.select("img", "seg", H.average_hash("qgrid").alias("h"))


_SEG = """sg AS (SELECT vec_id AS img, ((i // 8) // 4) * 2 + (i % 8) // 4 AS seg, ((i // 8) % 4) * 4 + (i % 8) % 4 AS pos, p FROM g),
  seg AS (SELECT img, seg, ('0b' || string_agg(CASE WHEN p > m THEN '1' ELSE '0' END, '' ORDER BY pos))::UBIGINT AS h
          FROM sg JOIN (SELECT img, seg, avg(p) AS m FROM sg GROUP BY ALL) USING (img, seg) GROUP BY img, seg),
  low AS (SELECT a.img, a.seg, b.img AS other, min(bit_count(xor(a.h, b.h))) AS lowest
          FROM seg a JOIN seg b ON a.img <> b.img AND bit_count(xor(a.h, b.h)) <= 2 GROUP BY ALL),
  diff AS (SELECT img, other, count(*) AS matches, sum(lowest)::BIGINT AS sum_distance FROM low GROUP BY ALL),
  score AS (SELECT img, other, matches, sum_distance,
                   round(4 - (matches - sum_distance / (matches * 16.0)), 6) AS score, matches >= 1 AS is_match FROM diff)"""


@query("multihash_diff", sql=_w(_G, _SEG) + "SELECT * FROM diff")
def q_multihash_diff(spark, sf_dir):
    """Per image pair, segments within 2 bits of the other image and their distance sum."""
    return imaging.multihash_diff(quadrant_segments(Tables(spark, sf_dir)), BITS16, 2)


@query("multihash_score", sql=_w(_G, _SEG) + "SELECT * FROM score")
def q_multihash_score(spark, sf_dir):
    """Multi-hash difference score and match test."""
    segs = quadrant_segments(Tables(spark, sf_dir))
    return imaging.multihash_score(imaging.multihash_diff(segs, BITS16, 2, counted=True, packed=True), segs, BITS16, digits=6)


@query("multihash_best", sql=_w(_G, _SEG) + """
    SELECT img, arg_min(other, (score, other)) AS best, min(score) AS score FROM score GROUP BY img""")
def q_multihash_best(spark, sf_dir):
    """The best candidate per image (lowest score, ties to the smaller id)."""
    segs = quadrant_segments(Tables(spark, sf_dir))
    return imaging.multihash_best(imaging.multihash_score(imaging.multihash_diff(segs, BITS16, 2, counted=True, packed=True), segs, BITS16, digits=6))


_CROP_SQL = """WITH RECURSIVE """ + _G + """,
  c AS (SELECT vec_id, i AS root, i AS pos FROM g
        UNION SELECT c.vec_id, c.root, b.i FROM c JOIN g a ON a.vec_id = c.vec_id AND a.i = c.pos
                     JOIN g b ON b.vec_id = a.vec_id AND (b.p > 128) = (a.p > 128)
                      AND (abs(b.i - a.i) = 8 OR abs(b.i - a.i) = 1 AND b.i // 8 = a.i // 8)),
  comp AS (SELECT vec_id, root AS i, min(pos) AS first FROM c GROUP BY vec_id, root),
  box AS (SELECT vec_id, first, bool_or(p > 128) AS bright, count(*) AS size, min(i % 8) AS min_x, min(i // 8) AS min_y,
                 max(i % 8) + 1 AS max_x, max(i // 8) + 1 AS max_y FROM comp JOIN g USING (vec_id, i) GROUP BY vec_id, first HAVING count(*) > 2),
  seg AS (SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY bright DESC, first) - 1 AS seg, size, min_x, min_y, max_x, max_y FROM box
          UNION ALL SELECT vec_id, 0, 2, 0, 0, 8, 8 FROM embeddings WHERE vec_id NOT IN (SELECT vec_id FROM box)),
  spot AS (SELECT s.*, k.k, g.p FROM seg s, range(16) AS k(k), g WHERE g.vec_id = s.vec_id
             AND g.i = (min_y + (k.k // 4) * (max_y - min_y) // 4) * 8 + min_x + (k.k % 4) * (max_x - min_x) // 4),
  mean AS (SELECT vec_id, seg, avg(p) AS m FROM spot GROUP BY vec_id, seg)
SELECT vec_id AS img, seg::INTEGER AS seg, size::INTEGER AS size, min_x::INTEGER AS min_x, min_y::INTEGER AS min_y, max_x::INTEGER AS max_x,
       max_y::INTEGER AS max_y, ('0b' || string_agg(CASE WHEN p > m THEN '1' ELSE '0' END, '' ORDER BY k))::BIGINT AS h
FROM spot JOIN mean USING (vec_id, seg) GROUP BY ALL"""


@query("crop_segments", sql=_CROP_SQL)
def q_crop_segments(spark, sf_dir):
    """bright/dark connected segments of each image, box and hash per segment."""
    g = grids(Tables(spark, sf_dir)).select("img", "grid")
    return imaging.crop_segments(g, W, W, threshold=128, min_size=2)


# ------------------------------------------- resampling, wavelets, wide hashes
def _matrix_sql(name: str, m) -> str:
    kind = int if m.dtype.kind == "i" else float
    rows = [f"({o}, {i}, {kind(w)!r})" for o, row in enumerate(m) for i, w in enumerate(row) if w != 0]
    return f"{name}(o, i, w) AS (SELECT o, i, w::{'BIGINT' if kind is int else 'DOUBLE'} FROM (VALUES " + ", ".join(rows) + ") AS v(o, i, w))"


def _resampled_sql(k: int, n: int) -> str:
    half, unit = 1 << (separable.PRECISION - 1), 1 << separable.PRECISION
    clip = f"least(greatest(floor((sum(p * w) + {half}) / {unit}), 0), 255)::INTEGER"
    return f"""{_matrix_sql(f'k{n}', separable.lanczos_matrix(k, n))},
  x{n} AS (SELECT vec_id, g.i // {k} AS y, o AS x, {clip} AS p FROM g JOIN k{n} m ON m.i = g.i % {k} GROUP BY ALL),
  r{n} AS (SELECT vec_id, o AS y, x, {clip} AS p FROM x{n} JOIN k{n} m ON m.i = x{n}.y GROUP BY ALL),
  l{n} AS (SELECT vec_id, list(p ORDER BY y, x) AS grid FROM r{n} GROUP BY vec_id)"""


@query("resampled_grid", sql=_w(_G, _resampled_sql(8, 5), _resampled_sql(8, 16)) + """
    SELECT vec_id AS img, l5.grid AS smaller, l16.grid AS larger FROM l5 JOIN l16 USING (vec_id)""")
def q_resampled_grid(spark, sf_dir):
    """Every 8x8 image resampled to 5x5 and to 16x16 (Lanczos-3, 8-bit rounding)."""
    g = grids(Tables(spark, sf_dir))
    return g.select("img", separable.resample("grid", W, W, 5, 5).alias("smaller"), separable.resample("grid", W, W, 16, 16).alias("larger"))


def _low_sql(name: str, levels: int, lowest: int | None) -> str:
    """Convolution sums of the 16x16 images, without their lowest Haar band."""
    low = separable.cascade(16, name, levels)
    if lowest == 4:
        base = "px16 AS (SELECT img, y, x, (p - avg(p) OVER (PARTITION BY img)) / 255 AS p FROM g16)"
    elif lowest is None:
        base = "px16 AS (SELECT img, y, x, p / 255 AS p FROM g16)"
    else:
        base = f"px16 AS (SELECT img, y, x, (p - avg(p) OVER (PARTITION BY img, y // {2**lowest}, x // {2**lowest})) / 255 AS p FROM g16)"
    return f"""{_matrix_sql('fb', low)}, {base},
  ax AS (SELECT img, y, o AS x, sum(p * w) AS p FROM px16 JOIN fb ON fb.i = px16.x GROUP BY ALL),
  ll AS (SELECT img, o AS y, x, sum(p * w) AS p FROM ax JOIN fb ON fb.i = ax.y GROUP BY ALL),
  md AS (SELECT img, median(p) AS m FROM ll GROUP BY img),
  tx AS (SELECT img, string_agg(CASE WHEN p > m THEN '1' ELSE '0' END, '' ORDER BY y, x) AS b FROM ll JOIN md USING (img) GROUP BY img)"""


def _hex_of_bits(b: str, n: int) -> str:
    """Hex digits of a text of n binary digits, four at a time from the right."""
    pad = -n % 4
    return f"""list_aggregate(list_transform(range(1, {n + pad}, 4), lambda j: format('{{:x}}', instr('0000 0001 0010 0011 0100 0101 0110 0111 1000 1001 1010 1011 1100 1101 1110 1111',
      substr('{'0' * pad}' || {b}, j, 4)) // 5)), 'string_agg', '')"""


@query("whash_db4", sql=_w(_G, _G16, _low_sql("db4", 1, 4)) + f"SELECT img, {_hex_of_bits('b', 121)} AS hash FROM tx")
def q_whash_db4(spark, sf_dir):
    """F8: Daubechies-4 wavelet hash of 16x16 images at hash size 8, lowest Haar band removed. The filter's borders make
    the low band 11 x 11, so the hash has 121 bits."""
    bits, n = separable.wavelet_bits("grid", 16, 8, "db4", remove_lowest=4)
    g = grids16(Tables(spark, sf_dir)).select("img", bits.alias("bits"))
    return g.select("img", wide.wide_hex(wide.pack_bits(F.col("bits"), n), n).alias("hash"))


@query("whash_db4_levels", sql=_w(_G, _G16, _low_sql("db4", 2, 2)) + f"SELECT img, {_hex_of_bits('b', 81)} AS hash FROM tx")
def q_whash_db4_levels(spark, sf_dir):
    """F8: two levels of the cascade, with the 4x4 block means (two Haar levels, reconstructed) taken away first."""
    bits, n = separable.wavelet_bits("grid", 16, 4, "db4", remove_lowest=2)
    g = grids16(Tables(spark, sf_dir)).select("img", bits.alias("bits"))
    return g.select("img", wide.wide_hex(wide.pack_bits(F.col("bits"), n), n).alias("hash"))


BITS_WIDE = 256


def _wide_hash(grid):
    """256-bit average hash of a 16x16 grid, as words."""
    return H.let(grid, lambda g: H.let(H.mean_of(g), lambda m: wide.pack_bits(F.transform(g, lambda p: p > m), BITS_WIDE)))


def wide_hashes(t: Tables) -> DataFrame:
    return grids16(t).select("img", _wide_hash(F.col("grid")).alias("h"))


_AW = """aw AS (SELECT img, string_agg(CASE WHEN p > m THEN '1' ELSE '0' END, '' ORDER BY y, x) AS b
        FROM g16 JOIN (SELECT img, avg(p) AS m FROM g16 GROUP BY 1) USING (img) GROUP BY img)"""


@query("hamming_wide", sql=_w(_G, _G16, _AW) + """
    SELECT a.img, b.img AS other, bit_count(xor(a.b::BIT, b.b::BIT))::INTEGER AS dist FROM aw a JOIN aw b ON b.img = a.img + 1""")
def q_hamming_wide(spark, sf_dir):
    """bit distance of the 256-bit average hashes of consecutive images."""
    h = wide_hashes(Tables(spark, sf_dir))
    nxt = h.select((F.col("img") - 1).alias("img"), F.col("img").alias("other"), F.col("h").alias("h2"))
    return h.join(nxt, "img").select("img", "other", wide.hamming_words("h", "h2").alias("dist"))


@query("hash_text_forms", sql=_w(_G, _G16, _AW) + f""", t AS (SELECT img, b, {_hex_of_bits('b', 256)} AS hash FROM aw),
    p AS (SELECT img, list_transform(range(4), lambda q: substr(hash, q * 16 + 1, 16)) AS parts FROM t)
    SELECT t.img, hash, list_aggregate(list_transform(parts, lambda x: x), 'string_agg', ',') AS multi, 4 AS parts,
           list_aggregate(list_transform(range(1, 257, 8), lambda j: list_aggregate(list_transform([j + 4, j], lambda k:
             format('{{:x}}', instr('0000 0001 0010 0011 0100 0101 0110 0111 1000 1001 1010 1011 1100 1101 1110 1111', reverse(substr(b, k, 4))) // 5)), 'string_agg', '')), 'string_agg', '') AS old,
           0 AS dist
    FROM t JOIN p USING (img)""")
def q_hash_text_forms(spark, sf_dir):
    """256-bit hashes as hex, as a multi-hash of four 64-bit segments, and in the old byte order; ``parts`` and ``dist``
    come from parsing these texts again (dist: bits by which a parsed hash differs from its source)."""
    h = wide_hashes(Tables(spark, sf_dir))
    segments = F.transform("h", lambda x: F.array(x))
    t = h.select("img", "h", wide.wide_hex("h", BITS_WIDE).alias("hash"), wide.multi_hex(segments, 64).alias("multi"), wide.wide_old_hex("h", BITS_WIDE).alias("old"))
    back = wide.hamming_words("h", wide.hex_wide("hash", BITS_WIDE)) + wide.hamming_words("h", wide.old_hex_wide("old", 16)) + wide.hamming_words(
        "h", F.flatten(wide.hex_multi("multi", 64)))
    return t.select("img", "hash", "multi", F.size(wide.hex_multi("multi", 64)).alias("parts"), "old", back.alias("dist"))


T_WIDE = 12


@query("hamming_join_wide", sql=_w(_G, _G16, _AW) + f""",
  n16 AS (SELECT img, y, x, CASE WHEN (y * 16 + x) % 41 = img % 41 THEN 255 - p ELSE p END AS p FROM g16),
  an AS (SELECT img, string_agg(CASE WHEN p > m THEN '1' ELSE '0' END, '' ORDER BY y, x) AS b
         FROM n16 JOIN (SELECT img, avg(p) AS m FROM n16 GROUP BY 1) USING (img) GROUP BY img)
    SELECT a.img, c.img AS copy, bit_count(xor(a.b::BIT, c.b::BIT))::INTEGER AS dist FROM aw a JOIN an c ON bit_count(xor(a.b::BIT, c.b::BIT)) <= {T_WIDE}""")
def q_hamming_join_wide(spark, sf_dir):
    """Every image and every altered copy (each 41st pixel inverted) within 12 of 256 bits; seven bands, probed one bit away."""
    g = grids16(Tables(spark, sf_dir))
    altered = F.transform("grid", lambda p, i: F.when(i % 41 == F.col("img") % 41, 255 - p).otherwise(p))
    left = g.select("img", _wide_hash(F.col("grid")).alias("h"))
    right = g.select("img", altered.alias("grid")).select(F.col("img").alias("copy"), _wide_hash(F.col("grid")).alias("h"))
    pairs = widejoin.hamming_pairs_wide(left, right, BITS_WIDE, T_WIDE, ["img"], ["copy"], bands=7)
    return pairs.select("img", F.col("r_copy").alias("copy"), "dist")

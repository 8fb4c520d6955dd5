"""Nested-data operators for landed API documents: flattening, JSON text
round trips, array-of-struct lookups, envelopes, item explosion, cost-sheet
loading and file fingerprints.

Everything is a built-in expression (``from_json``, ``explode``,
``filter``/``aggregate``/``exists`` higher-order functions, ``_metadata``),
so documents are processed inside the scan's tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.operators.dedupe import keep_one_per_key

ITEM_SCHEMA = T.ArrayType(T.StructType([
    T.StructField("renglon", T.IntegerType()),
    T.StructField("item", T.StructType([T.StructField("seller_sku", T.StringType()),
                                        T.StructField("title", T.StringType())])),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("sale_fee", T.DoubleType()),
]))


def flatten_struct_columns(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs → dotted top-level columns (``buyer.nickname``), the
    shape ``json_normalize`` produces.  Arrays stay arrays."""
    def walk(dtype: T.StructType, prefix: list[str]):
        out = []
        for f in dtype.fields:
            path = prefix + [f.name]
            if isinstance(f.dataType, T.StructType):
                out.extend(walk(f.dataType, path))
            else:
                ref = F.col(".".join(f"`{p}`" for p in path))
                out.append(ref.alias(sep.join(path)))
        return out
    return df.select(*walk(df.schema, []))



def _members(ddl: str) -> list[tuple[str, str]]:
    """(name, type) of the fields of ``OBJECT<a: …, b: …>``; commas and colons inside brackets or
    quotes belong to a type or a name."""
    out, depth, quoted, at, name = [], 0, False, 0, None
    body = ddl[len("OBJECT<"):-1]
    for i, c in enumerate(body + ","):
        if c == "`":
            quoted = not quoted
        elif quoted:
            continue
        elif c in "<(":
            depth += 1
        elif c in ">)":
            depth -= 1
        elif c == ":" and depth == 0 and name is None:
            name, at = body[at:i].strip(), i + 1
        elif c == "," and depth == 0:
            if name is not None:
                bare = name[1:-1].replace("``", "`") if name.startswith("`") else name
                out.append((bare, body[at:i].strip()))
            at, name = i + 1, None
    return out


def discovered_leaves(ddl: str) -> list[tuple[tuple[str, ...], str]]:
    """(path, type) of every leaf of a discovered schema, in the order of the paths. Objects are
    opened; arrays and fields whose documents disagree are text; numbers with a point are double."""
    out = []
    for name, kind in _members(ddl):
        if kind.startswith("OBJECT<"):
            out += [((name, *path), k) for path, k in discovered_leaves(kind)]
        elif kind.startswith("DECIMAL") or kind in ("DOUBLE", "FLOAT"):
            out.append(((name,), "double"))
        elif kind in ("BIGINT", "BOOLEAN"):
            out.append(((name,), kind.lower()))
        else:  # STRING, ARRAY<…>, VARIANT (documents disagree), VOID (only null seen)
            out.append(((name,), "string"))
    return sorted(out)


def _member(v: Column, name: str, kind: str) -> Column:
    """A field of a variant object; a path knows no escapes, so a name with both kinds of quotes is
    looked up in the object's map."""
    quote = "'" if "'" not in name else '"'
    if quote not in name:
        return F.try_variant_get(v, f"$[{quote}{name}{quote}]", kind)
    one = F.map_filter(F.from_json(F.to_json(v), "map<string,variant>"), lambda k, _: k == F.lit(name))
    return F.try_variant_get(F.get(F.map_values(one), 0), "$", kind)


def flatten_documents(df: DataFrame, doc: str, keep: Sequence[str] = (), sep: str = "_") -> DataFrame:
    """Documents of any shape as one flat table: the schema is not given but found in the documents.

    A first pass merges the shapes of all documents in an aggregate (combined before the shuffle;
    what reaches the driver is one type), a second one reads each leaf by its path. A field that one
    document lacks is null there. A field with values of different kinds is the value's JSON text, a
    string as it is. Two paths that give the same name, and names of ``keep``, get their number added.
    Text that is not JSON, or is no object, counts as an empty document."""
    text = F.col(doc).cast("string")
    shape = df.select(F.try_parse_json(text).alias("v")).where(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT<")))
    found = shape.agg(F.schema_of_variant_agg("v")).first()[0]
    leaves = discovered_leaves(found) if found and found.startswith("OBJECT<") else []
    cols, names = [], set(keep)
    for path, kind in leaves:
        name = sep.join(path)
        while name in names:
            name += "_2"
        names.add(name)
        v = F.col("_v")
        for part in path[:-1]:
            v = _member(v, part, "variant")
        cols.append(_member(v, path[-1], kind).alias(name))
    v = F.try_parse_json(text)
    return df.select(*keep, v.alias("_v")).select(*keep, *cols)


def nested_to_text(df: DataFrame) -> DataFrame:
    """Array/map/struct columns → JSON text (for a text-only sink); null
    fields stay as ``null`` (``to_json`` would drop their keys)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(F.col(f"`{f.name}`"), {"ignoreNullFields": "false"}).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def multiget_envelope(df: DataFrame, code: str = "code", body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Split ``{code, body}`` responses: (bodies with code 200, reject count);
    anything but 200 is a reject, a null code too."""
    good = F.col(code).eqNullSafe(F.lit(200))
    ok = df.where(good).select(f"{body}.*")
    rejects = df.agg(F.count_if(~good).alias("rejected"), F.count(F.lit(1)).alias("rows"))
    return ok, rejects


def land_multiget(df: DataFrame, path: str, code: str = "code", body: str = "body") -> dict[str, int]:
    """Writes the bodies with code 200 and returns ``rows`` and ``rejected``, counted by the write
    itself (observed metrics): the responses are read once."""
    good = F.col(code).eqNullSafe(F.lit(200))
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(~good).alias("rejected"))
    watched.where(good).select(f"{body}.*").write.parquet(path)
    return seen.get


def explode_items(orders: DataFrame, items: str = "order_items") -> DataFrame:
    """Header fields repeated on each item row; an order without items yields
    no rows."""
    e = orders.select("id", "status", "date_created", "buyer_nickname", F.explode(items).alias("it"))
    return e.select("id", "status", "date_created", "buyer_nickname",
                    F.col("it.renglon").alias("renglon"), F.col("it.item.seller_sku").alias("seller_sku"),
                    F.col("it.item.title").alias("title"), F.col("it.quantity").alias("quantity"),
                    F.col("it.unit_price").alias("unit_price"), F.col("it.sale_fee").alias("sale_fee"))


def items_from_json_text(orders: DataFrame, col: str = "order_items",
                         schema: T.DataType = ITEM_SCHEMA) -> DataFrame:
    """Parse a JSON-text array column; null or malformed → empty array."""
    parsed = F.from_json(F.col(col), schema)
    return orders.withColumn(col, F.coalesce(parsed, F.array().cast(schema)))


def first_matching(arr: str | Column, pred, field: str, default=None) -> Column:
    """``field`` of the first array element satisfying ``pred`` (a lambda on
    the element), else ``default``.  ``get`` is null-safe on an empty match
    (``arr[0]`` raises under ANSI)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    hit = F.get(F.filter(a, pred), 0)[field]
    return F.coalesce(hit, F.lit(default)) if default is not None else hit


def first_matching_cost(senders: str | Column, seller_id) -> Column:
    """Cost of the first sender whose ``user_id`` is the seller, else 0."""
    return first_matching(senders, lambda s: s["user_id"] == F.lit(seller_id), "cost", 0.0)


def attribute_value(attrs: str | Column, attr_id: str = "SELLER_SKU") -> Column:
    """``value_name`` of the attribute with the given id (array of structs or
    its JSON text)."""
    a = F.col(attrs) if isinstance(attrs, str) else attrs
    return first_matching(a, lambda x: x["id"] == F.lit(attr_id), "value_name")


ATTR_SCHEMA = T.ArrayType(T.StructType([T.StructField("id", T.StringType()),
                                        T.StructField("value_name", T.StringType())]))


def attribute_value_from_text(attrs_text: str | Column, attr_id: str = "SELLER_SKU") -> Column:
    a = F.col(attrs_text) if isinstance(attrs_text, str) else attrs_text
    return attribute_value(F.from_json(a, ATTR_SCHEMA), attr_id)


def wms_order_project(df: DataFrame) -> DataFrame:
    """Null-safe projection of nested warehouse order headers (a missing
    parent struct yields nulls, never an error)."""
    place, customer = F.col("clienteUbicacion"), F.col("clienteUbicacion.cliente")
    return df.select(
        F.col("codigo"), F.col("fecha"), F.col("estado"), F.col("importe"),
        customer["codigo"].alias("cliente_codigo"), customer["descripcion"].alias("cliente_nombre"),
        place["provincia"].alias("provincia"), place["localidad"].alias("localidad"),
        place["direccion"].alias("direccion"), F.col("codigoDespacho").alias("codigo_despacho"),
        F.col("servicioDeEnvioTipo").alias("servicio_envio"), F.col("ordenPreparacion").alias("orden_preparacion"))


def preparation_rollup(preps: DataFrame) -> DataFrame:
    """Per preparation: carrier, Σ packages over its containers, Σ volume and
    Σ grams → kg (round 3) over its items, type ``Pallets`` when any
    container's JSON text mentions pallet/pale, number of orders listed; then
    one row per (preparation, order), deduped.  Missing arrays count as empty,
    missing numbers as 0."""
    kind = {f.name: f.dataType for f in preps.schema.fields}
    arr = lambda name: F.coalesce(F.col(name), F.array().cast(kind[name]))
    total = lambda name, field: F.aggregate(
        arr(name), F.lit(0.0), lambda acc, c: acc + F.coalesce(c[field].cast("double"), F.lit(0.0)))
    text = lambda c: F.lower(F.to_json(c, {"ignoreNullFields": "false"}))
    pallets = F.exists(arr("contenedores"), lambda c: text(c).contains("pallet") | text(c).contains("pale"))
    described = F.when(F.col("despachoDescripcion") != "", F.col("despachoDescripcion"))
    per = preps.select(
        F.col("id").alias("preparacion_id"),
        F.coalesce(described, "despachoCodigo").alias("transporte"),
        total("contenedores", "cantidadBulto").alias("bultos_preparacion"),
        total("items", "volumen").alias("volumen_preparacion"),
        F.round(total("items", "peso") / 1000.0, 3).alias("kg_preparacion"),
        F.when(pallets, F.lit("Pallets")).otherwise(F.lit("Bultos")).alias("tipo_preparacion"),
        F.size(arr("pedidos")).alias("cant_pedidos_en_prep"),
        F.explode(arr("pedidos")).alias("p"),
    )
    rows = per.withColumn("pedido_codigo", F.col("p.codigo").cast("string")).drop("p")
    return keep_one_per_key(rows, ["preparacion_id", "pedido_codigo"], [])


# ---------------------------------------------------------------------------
# files
# ---------------------------------------------------------------------------

def cost_sheets_load(spark: SparkSession, costs_path: str, offers_path: str) -> tuple[DataFrame, DataFrame]:
    """Monthly sheet pairs exported as CSV, month taken from the file's path
    (``…2026-05…``); comma-decimal numbers and percentages parsed.

    ``_seq`` is the row's place in its sheet (file, then row within the file),
    so "the last row of a key wins" can be told from the greatest value."""
    from marginflow.functions import scalars as S

    month = F.regexp_extract(F.col("_metadata.file_path"), r"(\d{4}-\d{2})", 1)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
    read = lambda path, schema: spark.read.option("header", True).schema(schema).csv(path)
    c = (read(costs_path, "`Codigo` string, `Costo Teorico` string")
         .select(S.normalize_sku(F.col("Codigo")).alias("sku"), month.alias("mes_comercial"),
                 S.parse_decimal_comma(F.col("Costo Teorico")).alias("costo_teorico"), place.alias("_seq"))
         .where(F.col("sku").isNotNull()))
    o = (read(offers_path, "`SKU` string, `DESCUENTO TOTAL PROVEEDOR` string")
         .select(S.normalize_sku(F.col("SKU")).alias("sku"), month.alias("mes_comercial"),
                 S.parse_percent(F.col("DESCUENTO TOTAL PROVEEDOR")).alias("oferta_pct"), place.alias("_seq"))
         .where(F.col("sku").isNotNull()))
    return c, o


def file_manifest(spark: SparkSession, path_glob: str) -> DataFrame:
    """One row per file: name, size, modification time.  The files are listed,
    not read: the content column is pruned."""
    df = spark.read.format("binaryFile").load(path_glob)
    return df.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"),
                     F.col("modificationTime").alias("mtime"))


def sheet_manifest(spark: SparkSession, base: str, depth: int = 2) -> DataFrame:
    """One row per folder of files under ``base``, each a sheet: its path's last ``depth`` parts, size
    and newest modification time. Files are listed, not read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    parts = F.split("path", "/")
    name = F.array_join(F.slice(parts, F.size(parts) - depth, depth), "/")
    return df.groupBy(name.alias("name")).agg(F.sum("length").cast("bigint").alias("size"), F.max("modificationTime").alias("mtime"))


def fingerprint() -> Column:
    """Aggregate: sha2 over the (name|size|mtime) lines, whatever their order: each line's
    digest is summed as a number, so no list of all files is built."""
    line = F.concat_ws("|", "name", F.col("size").cast("string"), F.col("mtime").cast("string"))
    part = lambda k: F.sum(F.conv(F.substring(F.sha2(line, 256), 1 + 12 * k, 12), 16, 10).cast("decimal(38,0)"))
    return F.sha2(F.concat_ws("|", *[part(k).cast("string") for k in range(5)], F.count(F.lit(1)).cast("string")), 256)


def manifest_changed(current: Column, stored: Column) -> Column:
    """Absent or unreadable stored state counts as changed."""
    return stored.isNull() | ~current.eqNullSafe(stored)


MANIFEST = "name string, size bigint, mtime timestamp"


def stored_manifest(spark: SparkSession, state_path: str) -> DataFrame | None:
    """The manifest kept at ``state_path``; none where there is none or it cannot be read."""
    try:
        kept = spark.read.schema(MANIFEST).parquet(state_path)
        return kept if kept.count() >= 0 else None
    except Exception as e:  # a missing or broken state counts as changed, whatever broke it
        if "PATH_NOT_FOUND" not in str(e) and "FAILED_READ_FILE" not in str(e) and "Parquet" not in str(e):
            raise
        return None


def manifest_diff(now: DataFrame, kept: DataFrame | None) -> DataFrame:
    """(name, change) with change ``added``, ``removed``, ``changed`` or ``same``. Without a stored
    manifest every file is added."""
    if kept is None:
        return now.select("name", F.lit("added").alias("change"))
    a, b = now.select("name", F.struct("size", "mtime").alias("now")), kept.select("name", F.struct("size", "mtime").alias("was"))
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("now") != F.col("was"), "changed").otherwise("same")
    return a.join(b, "name", "full_outer").select("name", change.alias("change"))


def store_manifest(now: DataFrame, state_path: str) -> None:
    """Keeps the manifest for the next run; written only after the load has succeeded."""
    now.select("name", "size", "mtime").coalesce(1).write.mode("overwrite").parquet(state_path)

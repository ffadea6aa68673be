"""Layered drawings (SVG) flattened into rows."""

from __future__ import annotations

import shutil
import tempfile
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import affine

SCHEMA = "doc string, doc_order long, depth int, tag string, label string, id string, path array<string>, labels array<string>, layers array<string>, transforms array<string>, name string, first_span string, x string, y string, attrs map<string,string>"
LABEL = "{http://www.inkscape.org/namespaces/inkscape}label"
NAMESPACES = (("", "http://www.w3.org/2000/svg"), ("inkscape", "http://www.inkscape.org/namespaces/inkscape"), ("sodipodi", "http://sodipodi.sourceforge.net/DTD/sodipodi-0.dtd"), ("xlink", "http://www.w3.org/1999/xlink"))
MODE = "{http://www.inkscape.org/namespaces/inkscape}groupmode"
PIECE, STEP = 1 << 22, 1 << 18  # bytes of a drawing that come to Python at once, and that are parsed at once


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _name(elem: ET.Element) -> tuple[str | None, str | None]:
    """Text of an element: its own spans joined by blanks, else its own text; and its first span at any depth."""
    spans = [(s.text or "").strip() for s in elem if _local(s.tag) == "tspan"]
    own = " ".join(spans).strip() if any(spans) else (elem.text or "").strip()
    first = next(((s.text or "").strip() for s in elem.iter() if _local(s.tag) == "tspan"), None)
    return own or None, first or None


class _Rows:
    """Target of a parser that makes rows of the elements as they come, so that no tree of the drawing is ever held."""

    def __init__(self, doc: str):
        self.doc, self.order, self.found = doc, 0, []
        # what holds for the children of each open element: path, labels, layers, transforms
        self.above: list[tuple[list[str], list[str | None], list[str], list[str]]] = [([], [], [], [])]
        self.text, self.open = None, 0  # a text element is whole when it ends, and nothing inside of it has a row

    def start(self, tag: str, attrib: dict[str, str]) -> None:
        local = _local(tag)
        if self.text is None and local == "text":
            self.text = ET.TreeBuilder()
        if self.text is not None:
            self.text.start(tag, attrib)
            self.open += 1
            return
        transforms = self._add(local, attrib, None, None)
        path, labels, layers, _ = self.above[-1]
        label, ident = attrib.get(LABEL), attrib.get("id")
        if local == "g":
            path = path + ([label or ident] if label or ident else [])
            labels = labels + [label or None]
            layers = layers + ([label.lower()] if label and attrib.get(MODE) == "layer" else [])
        self.above.append((path, labels, layers, transforms))

    def data(self, text: str) -> None:
        if self.text is not None:
            self.text.data(text)

    def end(self, tag: str) -> None:
        if self.text is None:
            self.above.pop()
            return
        self.text.end(tag)
        self.open -= 1
        if not self.open:
            elem = self.text.close()
            self.text = None
            self._add("text", elem.attrib, *_name(elem))

    def _add(self, tag: str, attrib: dict[str, str], name: str | None, first: str | None) -> list[str]:
        path, labels, layers, transforms = self.above[-1]
        own = [*transforms, attrib.get("transform") or ""]
        attrs = {_local(k): v for k, v in attrib.items()}
        self.found.append((self.doc, self.order, len(self.above) - 1, tag, attrib.get(LABEL), attrib.get("id"), path, labels, layers, own, name, first, attrib.get("x"), attrib.get("y"), list(attrs.items())))
        self.order += 1
        return own


def _pieces(documents: DataFrame) -> DataFrame:
    """``doc``, ``part``, ``last`` and ``piece``: each drawing's text as bytes, cut into pieces that follow one another; one piece, null or empty, where there is no text."""
    size = F.greatest(F.coalesce(F.ceil(F.octet_length("xml") / PIECE), F.lit(1)), F.lit(1)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.substring(F.col("xml").cast("binary"), i * PIECE + 1, F.lit(PIECE)))
    return documents.select("doc", size.alias("n"), F.posexplode(cut).alias("part", "piece")).select("doc", "part", (F.col("part") == F.col("n") - 1).alias("last"), "piece")


def _fed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bool, bool, memoryview]]:
    """Drawing, whether its text begins and ends, and the text in small steps."""
    for batch in batches:
        for doc, part, last, piece in zip(*batch.columns, strict=True):
            view = memoryview(piece.as_buffer()) if piece.is_valid else memoryview(b"")
            for at in range(0, max(len(view), 1), STEP):
                yield doc.as_py(), part.as_py() == 0 and at == 0, last.as_py() and at + STEP >= len(view), view[at : at + STEP]


def flatten(documents: DataFrame) -> DataFrame:
    """One row per element of each drawing (``doc``, ``xml``), in document order.

    ``path`` holds the labels (else ids) of the groups around it, outermost first, for
    messages; ``labels`` the labels alone, null for a group without one; ``layers``
    those of its layers in lower case, ``transforms`` all transforms down
    to its own.  A drawing is one row, so drawings spread over the cluster.  It comes to
    Python in pieces and is parsed as they come.
    """
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<string>": pa.list_(pa.string()), "map<string,string>": pa.map_(pa.string(), pa.string())}
    columns = [c.split() for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, parser = None, None
        for doc, begins, ends, text in _fed(batches):
            if begins:
                rows = _Rows(doc)
                parser = ET.XMLParser(target=rows, encoding="utf-8") if len(text) else None
            if parser:
                parser.feed(text)
                if ends:
                    parser.close()
            if rows.found:
                yield pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for v, (_, k) in zip(zip(*rows.found, strict=True), columns, strict=True)], names=[c for c, _ in columns])
                rows.found = []

    return _pieces(documents).mapInArrow(run, SCHEMA)


def read_drawings(spark: SparkSession, path: str) -> DataFrame:
    """Flattened rows of every drawing under ``path``."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("doc"), F.col("value").alias("xml"))
    return flatten(files)


def placed(rows: DataFrame, transforms: bool = True) -> DataFrame:
    """Adds ``px``, ``py`` (absolute), ``lon`` and ``lat``; a position that isn't a number is null, one that is absent 0."""
    from ..functions import geo

    x = F.when(rows["x"].isNull(), 0.0).otherwise(rows["x"].try_cast("double"))
    y = F.when(rows["y"].isNull(), 0.0).otherwise(rows["y"].try_cast("double"))
    out = rows.withColumn("_x", x).withColumn("_y", y)
    if transforms:
        m = affine.compose_all(F.transform("transforms", lambda x: affine.parse_transform(x)))
        out = out.withColumn("_m", m)
        out = out.withColumn("px", affine.apply_x(F.col("_m"), F.col("_x"), F.col("_y"))).withColumn("py", affine.apply_y(F.col("_m"), F.col("_x"), F.col("_y"))).drop("_m")
    else:
        out = out.withColumn("px", F.col("_x")).withColumn("py", F.col("_y"))
    return out.drop("_x", "_y").withColumn("lon", geo.longitude(F.col("px"))).withColumn("lat", geo.latitude(F.col("py")))


def reject_reason() -> Column:
    """Why an element of a settlement group isn't a settlement; null if it is."""
    bad = lambda c: F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()
    return F.when(F.col("tag") != "text", "Not a text element").when(F.col("name").isNull(), "No text content").when(bad("x") | bad("y"), "Invalid coordinates")


def _below(layer: str, steps: int) -> Column:
    """Label of the group so many steps below the outermost one of that label; null if it has none."""
    return F.get("labels", (F.array_position("labels", F.lit(layer)) - 1 + steps).cast("int"))


def _in(layer: str) -> Column:
    return F.array_contains("labels", layer)


# Factions whose elements are left out without a word.
SILENT = ("karaz_ankor", "wood_elves")

# Faction, its layer, and its province where that isn't a layer of its own.
FACTIONS = (
    ("empire", "Empire", None),
    ("westerland", "Westerland", "Westerland"),
    ("bretonnia", "Bretonnia", "Bretonnia"),
    ("kislev", "Kislev", "Kislev"),
    ("tilea", "Tilea", "Tilea"),
    ("karaz_ankor", "Dwarf Holds", None),
    ("wood_elves", "Wood Elves", None),
)
# Layer names and the types they stand for.
POI_TYPES = {"Other": "Other", "City Districts": "City Districts", "Forts and Castles": "Forts and Castles", "Monastaries and Temples": "Monasteries and Temples", "Taverns and Inns": "Taverns and Inns"}
REGION_TYPES = {"Nation-States": "Nation-State", "Grand-Provinces": "Grand-Province", "Provinces": "Province"}
WATER_TYPES = {"ocean": "Ocean", "major-sea": "Major Sea", "large-sea": "Large Sea", "medium-sea": "Medium Sea", "small-sea": "Small Sea", "small-marsh": "Small Marsh", "large-marsh": "Large Marsh", "lakes": "Lake"}


def _lookup(table: dict[str, str], key: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, value in table.items():
        out = F.when(key == name, value).otherwise(out)
    return out


def settlements(rows: DataFrame, factions: tuple = FACTIONS) -> DataFrame:
    """Elements of all factions' settlement groups in one pass, with ``faction``, ``province``, ``scope`` and ``reason``.

    A province group's label is its province where the faction has provinces; what
    lies in a group without label there belongs to none and is left out.  Groups
    themselves aren't elements.  Rows with a reason are the rejected ones, of which
    there are none for factions that reject silently.
    """
    faction, province, scope = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, layer, constant in factions:
        here = _below("Settlements", 1) == layer
        faction = F.when(here, name).otherwise(faction)
        own = _below("Settlements", 2) if layer == "Empire" else F.lit(constant)
        province = F.when(here, own).otherwise(province)
        scope = F.when(here, F.concat_ws("/", F.lit(name), own if layer == "Empire" else F.lit(None))).otherwise(scope)
    out = placed(rows.where(_in("Settlements") & (F.col("tag") != "g")))
    out = out.withColumn("faction", faction).withColumn("province", province).withColumn("scope", scope).where("faction is not null")
    out = out.where("faction <> 'empire' or province is not null").withColumn("reason", reject_reason())
    return out.where(~(F.col("faction").isin(*SILENT) & F.col("reason").isNotNull()))


def points_of_interest(rows: DataFrame) -> DataFrame:
    """Named points with their type; an unknown layer is its own type, one without label is left out."""
    kind = _below("Points of Interest", 1)
    named = rows.where(_in("Points of Interest") & (F.col("tag") == "text") & F.col("name").isNotNull() & kind.isNotNull())
    return placed(named).withColumn("poi_type", F.coalesce(_lookup(POI_TYPES, kind), kind)).where("px is not null and py is not null")


def region_labels(rows: DataFrame) -> DataFrame:
    """Region labels of the three known layers."""
    named = rows.where(_in("Region Labels") & (F.col("tag") == "text") & F.col("name").isNotNull())
    return placed(named).withColumn("province_type", _lookup(REGION_TYPES, _below("Region Labels", 1))).where("province_type is not null and px is not null and py is not null")


def water_labels(rows: DataFrame) -> DataFrame:
    """Water labels of the known layers; marshes lie one layer deeper."""
    layer = F.when(_below("Water Labels", 1) == "marshes", _below("Water Labels", 2)).otherwise(_below("Water Labels", 1))
    named = rows.where(_in("Water Labels") & (F.col("tag") == "text") & F.col("name").isNotNull())
    return placed(named).withColumn("waterbody_type", _lookup(WATER_TYPES, layer)).where("waterbody_type is not null and px is not null and py is not null")


def route_inputs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths (``path_id``, ``path_ord``, ``d``, ``style``) and locations (``name``, ``x``, ``y``) of the layers of those names.

    No transforms here; of repeated ids and names the last counts.
    """
    from ..operators.dedupe import last_wins

    paths = rows.where((F.col("tag") == "path") & F.array_contains("layers", "paths"))
    paths = last_wins(paths.select("doc", "doc_order", F.col("id").alias("path_id"), F.col("attrs")["d"].alias("d"), F.col("attrs")["style"].alias("style")), ["doc", "path_id"], "doc_order")
    spots = rows.where((F.col("tag") == "text") & F.array_contains("layers", "locations") & F.col("first_span").isNotNull())
    spots = spots.select("doc", "doc_order", F.col("first_span").alias("name"), F.coalesce(F.col("x").try_cast("double"), F.lit(0.0)).alias("x"), F.coalesce(F.col("y").try_cast("double"), F.lit(0.0)).alias("y"))
    return paths.withColumnRenamed("doc_order", "path_ord"), last_wins(spots, ["doc", "name"], "doc_order")


def frame_bounds(rows: DataFrame, name: str) -> DataFrame:
    """Box (x0, y0, x1, y1) of the first rectangle with that label or id, its transforms applied."""
    first = rows.where((F.col("label") == name) | (F.col("id") == name)).groupBy("doc").agg(F.min_by(F.struct("tag", "attrs", "transforms"), "doc_order").alias("r"))
    num = lambda k: F.coalesce(F.col("r.attrs")[k].try_cast("double"), F.lit(0.0))
    m = affine.compose_all(F.transform("r.transforms", lambda t: affine.parse_transform(t, strict=True)))
    boxed = first.where("r.tag = 'rect'").withColumn("m", m).withColumn("x", num("x")).withColumn("y", num("y")).withColumn("w", num("width")).withColumn("h", num("height"))
    corners = [(F.col("x") + F.col("w") * i, F.col("y") + F.col("h") * j) for i in (0, 1) for j in (0, 1)]
    xs = [affine.apply_x(F.col("m"), *c) for c in corners]
    ys = [affine.apply_y(F.col("m"), *c) for c in corners]
    return boxed.select("doc", F.least(*xs).alias("x0"), F.least(*ys).alias("y0"), F.greatest(*xs).alias("x1"), F.greatest(*ys).alias("y1"))


def document_scale(rows: DataFrame) -> DataFrame:
    """Pixels a unit and origin of each drawing, from its view box, width and height."""
    from ..functions.values import length_px

    box = F.transform(F.split(F.trim(F.col("attrs")["viewBox"]), r"[\s,]+"), lambda v: v.try_cast("double"))
    root = rows.where("depth = 0").withColumn("box", box)
    at = lambda i: F.get("box", F.lit(i))
    return root.select("doc", (length_px(F.col("attrs")["width"]) / at(2)).alias("scale_x"), (length_px(F.col("attrs")["height"]) / at(3)).alias("scale_y"), at(0).alias("view_x"), at(1).alias("view_y"))


def transform_log(rows: DataFrame) -> DataFrame:
    """Groups that have a transform of their own, each once."""
    own = F.element_at("transforms", -1)
    return rows.where((F.col("tag") == "g") & (own != "")).select("doc", "doc_order", F.array_join(F.concat("path", F.array(F.coalesce("label", "id", F.lit("")))), "/").alias("layer_path"), own.alias("transform"))


def transform_audit(rows: DataFrame, *under: str) -> DataFrame:
    """Labelled groups right below a layer path, with their transform or that they have none."""
    own = F.element_at("transforms", -1)
    inside = F.lit(True)
    for i, label in enumerate(under):
        inside = inside & (F.get("labels", F.lit(i)) == label)
    here = rows.where(inside & (F.size("labels") == len(under)) & (F.col("tag") == "g") & F.col("label").isNotNull())
    return here.select("doc", "label", F.when(own == "", "NO TRANSFORM").otherwise(own).alias("transform"))


def relabelled(rows: DataFrame) -> DataFrame:
    """Text elements with what their label should be and ``status``: updated, already or no_text."""
    return rows.where("tag = 'text'").select("doc", "doc_order", "path", "label", "name", F.when(F.col("name").isNull(), "no_text").when(F.col("label").eqNullSafe(F.col("name")), "already").otherwise("updated").alias("status"))


class _Open:
    """An element that hasn't ended: whether its children are reached and get labels, and its text up to its first child."""

    __slots__ = ("tag", "attrib", "live", "labelled", "parts", "spans", "leading", "bare", "slot")

    def __init__(self, tag: str, attrib: dict[str, str], live: bool, labelled: bool, collected: bool):
        self.tag, self.attrib, self.live, self.labelled = tag, attrib, live, labelled
        self.parts, self.spans = [] if collected else None, []
        self.leading, self.bare, self.slot = True, True, -1

    def own(self) -> str:
        return "".join(self.parts).strip()


class _Labels:
    """Target of a parser that counts the labels to write and, given ``write`` and the prefixed names, writes the drawing with them.

    It notes the names in the order in which a tree's serializer meets them, since
    that numbers the prefixes of unknown namespaces.
    """

    GROUP, TEXT = "{http://www.w3.org/2000/svg}g", "{http://www.w3.org/2000/svg}text"

    def __init__(self, layers: list[str], write: Callable[[bytes], object] | None = None, names: tuple[dict, dict] | None = None):
        self.wanted, self.write, self.names = set(layers), write, names
        self.changed, self.met, self.stack, self.out, self.waiting = 0, {}, [], [], 0

    def start(self, tag: str, attrib: dict[str, str]) -> None:
        top = self.stack[-1] if self.stack else None
        first = tag == self.GROUP and attrib.get(LABEL) in self.wanted
        if first:
            self.wanted.discard(attrib[LABEL])
        labelled = bool(top and top.live and tag == self.TEXT)
        own = _Open(tag, attrib, first or bool(top and top.live and tag == self.GROUP), labelled, labelled or bool(top and top.labelled and _local(tag) == "tspan"))
        if top:
            top.leading = False
        if self.write is None:
            self.met.setdefault(tag, True)
            for key in attrib:
                self.met.setdefault(key, False)
        else:
            self._close_tag(top)
            own.slot = len(self.out)
            self.out.append(None if labelled else self._tag(own, not self.stack))
            self.waiting += labelled
        self.stack.append(own)

    def data(self, text: str) -> None:
        top = self.stack[-1]
        if top.leading and top.parts is not None:
            top.parts.append(text)
        if self.write is not None:
            self._close_tag(top)
            self.out.append(ET._escape_cdata(text))

    def end(self, tag: str) -> None:
        own = self.stack.pop()
        if own.labelled:
            name = " ".join(own.spans).strip() if any(own.spans) else own.own()
            if name and own.attrib.get(LABEL) != name:
                own.attrib[LABEL] = name
                self.changed += 1
        if own.parts is not None and self.stack and self.stack[-1].labelled and _local(tag) == "tspan":
            self.stack[-1].spans.append(own.own())
        if self.write is None:
            return
        if own.labelled:
            self.out[own.slot] = self._tag(own, not self.stack)
            self.waiting -= 1
        self.out.append(" />" if own.bare else f"</{self.names[0][tag]}>")
        if not self.waiting and (len(self.out) > 1000 or not self.stack):
            self.write("".join(self.out).encode())
            self.out = []

    def _close_tag(self, top: _Open | None) -> None:
        if top and top.bare:
            top.bare = False
            self.out.append(">")

    def _tag(self, own: _Open, root: bool) -> str:
        names, spaces = self.names
        declared = [f' xmlns{":" + p if p else ""}="{ET._escape_attrib(uri)}"' for uri, p in sorted(spaces.items(), key=lambda x: x[1])] if root else []
        return "".join(["<", names[own.tag], *declared, *[f' {names[k]}="{ET._escape_attrib(v)}"' for k, v in own.attrib.items()]])

    def prefixed(self) -> tuple[dict, dict]:
        """Names with their prefixes and the namespaces, as the serializer gives them to a tree that has these names in this order."""
        root, *others = self.met
        tree = ET.Element(root)
        for name in others:
            ET.SubElement(tree, name if self.met[name] else root, {} if self.met[name] else {name: ""})
        return ET._namespaces(tree)


def with_labels(documents: DataFrame, layers: list[str]) -> DataFrame:
    """Drawings whose text elements below the first group of each layer's label carry their text as label, with ``changed``: how many are new.

    A drawing in which nothing changes stays as it was, byte for byte; one that
    changes keeps its XML declaration.  Elements are reached through groups only.
    A drawing is read twice from a local file, once to count and once to write, and never held as a tree.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for prefix, uri in NAMESPACES:
            ET.register_namespace(prefix, uri)
        for doc, begins, ends, text in _fed(batches):
            if begins:
                given, empty, labels = tempfile.TemporaryFile(), not len(text), _Labels(layers)
                parser = ET.XMLParser(target=labels, encoding="utf-8")
            given.write(text)
            if not empty:
                parser.feed(text)
            if not ends:
                continue
            with given, pa.BufferOutputStream() as out:
                if not empty:
                    parser.close()
                given.seek(0)
                if not labels.changed:
                    shutil.copyfileobj(given, out, STEP)
                else:
                    head = given.read(STEP)
                    if head.startswith(b"<?xml"):
                        out.write(head[: head.index(b"?>") + 2] + b"\n")
                    writer = ET.XMLParser(target=_Labels(layers, out.write, labels.prefixed()), encoding="utf-8")
                    writer.feed(head)
                    while more := given.read(STEP):
                        writer.feed(more)
                    writer.close()
                xml = out.getvalue()
            made = pa.StringArray.from_buffers(1, pa.array([0, xml.size], pa.int32()).buffers()[1], xml)
            yield pa.RecordBatch.from_arrays([pa.array([doc], pa.string()), made, pa.array([labels.changed], pa.int32())], names=["doc", "xml", "changed"])

    absent = documents.where("xml is null").select("doc", "xml", F.lit(0).alias("changed"))
    return _pieces(documents.where("xml is not null")).mapInArrow(run, "doc string, xml string, changed int").unionByName(absent)


def hidden_element(rows: DataFrame, name: str = "Frame (Old World)") -> DataFrame:
    """The first element of each drawing with that label or id, and its style with display none."""
    from ..functions.values import with_display

    first = rows.where((F.col("label") == name) | (F.col("id") == name)).groupBy("doc").agg(F.min_by(F.struct("doc_order", "attrs"), "doc_order").alias("r"))
    return first.select("doc", "r.doc_order", with_display(F.col("r.attrs")["style"], "none").alias("style"))


def layer_visibility(rows: DataFrame, shown: list[str]) -> DataFrame:
    """Top-level layers with the style that shows those of ``shown`` and hides the rest."""
    from ..functions.values import with_display

    style = F.col("attrs")["style"]
    top = rows.where((F.col("depth") == 1) & (F.col("tag") == "g"))
    return top.select("doc", "doc_order", "label", F.when(F.col("label").isin(shown), with_display(style, "inline")).otherwise(with_display(style, "none")).alias("style"))


def numbered(kind: str, group: str, order: str) -> Column:
    """Ids of a kind from 0 in each group's order."""
    return F.format_string(f"{kind}_%03d", F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1)


def roads(rows: DataFrame, samples: int = 20) -> DataFrame:
    """Paths below the Roads layer as georeferenced points, numbered from 0 by kind; no transforms apply."""
    from ..functions import geo
    from ..functions.paths import path_points

    kind = _below("Roads", 1)
    found = rows.where(_in("Roads") & (F.col("tag") == "path") & kind.isNotNull())
    points = F.transform(path_points(F.col("attrs")["d"], samples), lambda p: F.struct(geo.longitude(p["x"]).alias("x"), geo.latitude(p["y"]).alias("y")))
    return found.withColumn("road_id", numbered("road", "doc", "doc_order")).select("doc", "doc_order", "road_id", kind.alias("road_type"), F.col("attrs")["d"].alias("svg_path"), points.alias("points"))

"""Classes, properties and links of ontologies from their statements, and what subclasses inherit.

Statements are (s, p, o, o_kind); classes are named by their URIs. Every operator is a join or a grouping on URIs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.uris import DEFAULT_NAMESPACE, datatype, local_name, namespace
from ..sources.store import written

# Names of the vocabularies.
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
SUBCLASS = "http://www.w3.org/2000/01/rdf-schema#subClassOf"
DOMAIN = "http://www.w3.org/2000/01/rdf-schema#domain"
RANGE = "http://www.w3.org/2000/01/rdf-schema#range"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
LEVELS = 100  # a longer chain of parents is a cycle


def statements(triples: DataFrame, s: str | None = None, p: str | None = None, o: str | None = None) -> DataFrame:
    for name, value in (("s", s), ("p", p), ("o", o)):
        triples = triples if value is None else triples.filter(F.col(name) == value)
    return triples


def ontology_uri(triples: DataFrame, key: str = "ontology_id") -> DataFrame:
    """(key, uri): the one subject typed as an ontology; null where none or several are."""
    named = statements(triples, p=RDF_TYPE, o=OWL + "Ontology").groupBy(key).agg(F.count("*").alias("n"), F.first("s").alias("uri"))
    return triples.select(key).distinct().join(named, key, "left").select(key, F.when(F.col("n") == 1, F.col("uri")).alias("uri"))


def default_namespace(namespaces: DataFrame) -> DataFrame:
    """namespaces(ssd_id, pos, namespace) -> the first that isn't empty, or the library's own."""
    return namespaces.groupBy("ssd_id").agg(F.coalesce(F.min_by("namespace", F.when(F.col("namespace") != "", F.col("pos"))), F.lit(DEFAULT_NAMESPACE)).alias("namespace"))


def parents(triples: DataFrame) -> DataFrame:
    """(class, parent): one parent a class, the greatest URI of several."""
    return statements(triples, p=SUBCLASS).filter("o_kind = 'uri'").groupBy(F.col("s").alias("class")).agg(F.max("o").alias("parent"))


def of_many_parents(triples: DataFrame) -> DataFrame:
    return statements(triples, p=SUBCLASS).filter("o_kind = 'uri'").groupBy(F.col("s").alias("class")).agg(F.countDistinct("o").alias("n")).filter("n > 1")


def _typed(triples: DataFrame, kind: str) -> DataFrame:
    return statements(triples, p=RDF_TYPE, o=OWL + kind).select("s").distinct()


def classes(triples: DataFrame) -> DataFrame:
    """Declared classes and those that properties and subclass statements name, once each."""
    uri = triples.filter("o_kind = 'uri'")
    objects = _typed(triples, "ObjectProperty")
    out = _typed(triples, "Class").select(F.col("s").alias("class"))
    for x in (statements(uri, p=SUBCLASS).select("s"), statements(uri, p=SUBCLASS).select("o"), statements(uri, p=DOMAIN).select("o"), statements(uri, p=RANGE).join(objects, "s", "left_semi").select("o")):
        out = out.union(x)
    return out.distinct()


def _ends(triples: DataFrame, kind: str) -> DataFrame:
    """(s, domain, range): every domain of a property with every range of it."""
    mine = triples.join(_typed(triples, kind), "s", "left_semi").filter("o_kind = 'uri'")
    return statements(mine, p=DOMAIN).select("s", F.col("o").alias("domain")).join(statements(mine, p=RANGE).select("s", F.col("o").alias("range")), "s", "left" if kind == "DatatypeProperty" else "inner")


def links(triples: DataFrame) -> DataFrame:
    """(src, label, dst, prefix) of object properties, once each."""
    return _ends(triples, "ObjectProperty").select(F.col("domain").alias("src"), local_name(F.col("s")).alias("label"), F.col("range").alias("dst"), namespace(F.col("s")).alias("prefix")).distinct()


def data_properties(triples: DataFrame) -> DataFrame:
    """(class, label, dtype, prefix); without a range the type is string."""
    dtype = datatype(F.replace("range", F.lit(XSD), F.lit("xsd:")))
    return _ends(triples, "DatatypeProperty").select(F.col("domain").alias("class"), local_name(F.col("s")).alias("label"), dtype.alias("dtype"), namespace(F.col("s")).alias("prefix")).distinct()


def chain(names: DataFrame, parent: DataFrame) -> DataFrame:
    """(class, ancestor, depth): each class, itself at depth 0, its parent at 1 and so on.

    Ways of 1, 2, 4, .. levels are joined with themselves, so that a hierarchy takes as many rounds as the logarithm of its
    depth. Classes on or under a cycle have no end and raise, as do more than LEVELS levels.
    """
    out = written(names.select("class", F.col("class").alias("ancestor"), F.lit(0).alias("depth")))
    far, length = parent.select("class", F.col("parent").alias("ancestor")), 1  # ancestors exactly `length` levels up
    while True:
        up = far.select(F.col("class").alias("ancestor"), F.col("ancestor").alias("top"))
        more = written(out.join(up, "ancestor").select("class", F.col("top").alias("ancestor"), (F.col("depth") + length).alias("depth")))
        if more.isEmpty():
            return out
        if length > LEVELS or not more.filter(F.col("depth") > LEVELS).isEmpty():
            raise ValueError("a class is its own ancestor")
        out, far, length = out.union(more), written(far.join(up, "ancestor").select("class", F.col("top").alias("ancestor"))), 2 * length


def extended_chain(chains: DataFrame, new: DataFrame, parent: DataFrame) -> DataFrame:
    """chains with the rows of new(class), whose parent(class, parent) are old or new classes: only new classes' rows are made."""
    mine = chain(new, parent.join(new, "class", "left_semi"))
    over = chains.select(F.col("class").alias("ancestor"), F.col("ancestor").alias("top"), F.col("depth").alias("more")).filter("more > 0 OR ancestor <> top")
    return chains.union(mine).union(mine.join(over, "ancestor").select("class", F.col("top").alias("ancestor"), (F.col("depth") + F.col("more")).alias("depth")))


def ordered(chains: DataFrame) -> DataFrame:
    """(class, depth): parents have a lower depth than their children."""
    return chains.groupBy("class").agg(F.max("depth").alias("depth"))


def inherited(chains: DataFrame, properties: DataFrame) -> DataFrame:
    """(class, label, dtype, prefix): data properties of a class and its ancestors, the nearest of one label."""
    p = properties.withColumnRenamed("class", "ancestor")
    nearest = F.struct("depth", "dtype", "prefix")
    return chains.join(p, "ancestor").groupBy("class", "label").agg(F.min(nearest).alias("m")).select("class", "label", "m.dtype", "m.prefix")


def descendants(chains: DataFrame) -> DataFrame:
    return chains.select(F.col("ancestor").alias("class"), F.col("class").alias("descendant"))


def inferred_links(links_: DataFrame, chains: DataFrame) -> DataFrame:
    """Every link, carried to all descendants of both ends."""
    d = descendants(chains)
    a = d.select(F.col("class").alias("src"), F.col("descendant").alias("src_"))
    b = d.select(F.col("class").alias("dst"), F.col("descendant").alias("dst_"))
    return links_.join(a, "src").join(b, "dst").select(F.col("src_").alias("src"), "label", F.col("dst_").alias("dst"), "prefix").distinct()


def class_violations(known: DataFrame, new: DataFrame) -> DataFrame:
    """new(class, parent, properties array) that can't be added, and why."""
    missing = new.filter("parent IS NOT NULL").join(known.union(new.select("class")).select(F.col("class").alias("parent")).distinct(), "parent", "left_anti").select("class", F.lit("no such parent").alias("why"))
    twice = new.filter(F.size("properties") != F.size(F.array_distinct("properties"))).select("class", F.lit("repeated property").alias("why"))
    return missing.union(twice)


def link_violations(known: DataFrame, new: DataFrame) -> DataFrame:
    """new(src, label, dst) with an end that isn't a class."""
    return new.join(known.select(F.col("class").alias("src")), "src", "left_anti").union(new.join(known.select(F.col("class").alias("dst")), "dst", "left_anti").select("src", "label", "dst")).distinct()


def added_classes(known: DataFrame, parent: DataFrame, properties: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes, parents and data properties with new(class, parent, properties array), but for those that class_violations names."""
    good = new.join(class_violations(known, new).select("class"), "class", "left_anti")
    pairs = parent.union(good.filter("parent IS NOT NULL").select("class", "parent")).groupBy("class").agg(F.max("parent").alias("parent"))
    made = good.select("class", F.explode("properties").alias("label"), F.lit("string").alias("dtype"), F.lit(DEFAULT_NAMESPACE).alias("prefix"))
    return known.select("class").union(good.select("class")).distinct(), pairs, properties.union(made.select(*properties.columns)).distinct()


def added_links(known: DataFrame, links_: DataFrame, new: DataFrame, prefix: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Links with new(src, label, dst), but for those with an end that isn't a class."""
    good = new.join(link_violations(known, new), ["src", "label", "dst"], "left_anti")
    return links_.select("src", "label", "dst", "prefix").union(good.select("src", "label", "dst", F.lit(prefix))).distinct()


def without_links(links_: DataFrame, gone: DataFrame) -> DataFrame:
    """Links but for gone(src, label, dst)."""
    return links_.join(gone, ["src", "label", "dst"], "left_anti").select(*links_.columns)


def found_classes(known: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted(label, prefix or null) with the class of that local name, and status ok, missing or ambiguous."""
    c = known.select("class", local_name(F.col("class")).alias("label"), namespace(F.col("class")).alias("ns"))
    fits = F.col("prefix").isNull() | (F.col("prefix") == F.col("ns"))
    hits = wanted.select("label", "prefix").distinct().join(c, "label", "left").withColumn("class", F.when(fits, F.col("class")))
    hits = hits.groupBy("label", "prefix").agg(F.count("class").alias("n"), F.min("class").alias("class"))
    return hits.select("label", "prefix", F.when(F.col("n") == 1, F.col("class")).alias("class"), F.when(F.col("n") == 0, "missing").when(F.col("n") > 1, "ambiguous").otherwise("ok").alias("status"))


def all_links(links_: DataFrame, properties: DataFrame) -> DataFrame:
    """(src, label, dst, kind): class links, to a class, and data links, to a data node of the class."""
    data = properties.select(F.col("class").alias("src"), "label", F.concat_ws(".", local_name(F.col("class")), "label").alias("dst"), F.lit("data").alias("kind"))
    return links_.select("src", "label", "dst", F.lit("class").alias("kind")).union(data)


def summary(known: DataFrame, properties: DataFrame, links_: DataFrame) -> DataFrame:
    """One row: how many classes, data properties and links."""
    count = lambda df, name: df.agg(F.count("*").alias(name))
    return count(known, "class_nodes").join(F.broadcast(count(properties, "data_nodes"))).join(F.broadcast(count(links_, "links")))


def without(gone: DataFrame, properties: DataFrame, links_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Data properties and links left once the classes gone(class) are removed."""
    ends = links_.join(gone.select(F.col("class").alias("src")), "src", "left_anti").join(gone.select(F.col("class").alias("dst")), "dst", "left_anti")
    return properties.join(gone, "class", "left_anti"), ends.select(*links_.columns)


def to_statements(parent: DataFrame, names: DataFrame, links_: DataFrame, properties: DataFrame) -> DataFrame:
    """Classes, parents, object and data properties as statements again."""
    st = lambda df, s, p, o: df.select(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit("uri").alias("o_kind"))
    link, prop = F.concat("prefix", "label"), F.concat("prefix", "label")
    back = F.create_map(*[F.lit(x) for x in ("string", XSD + "string", "long", XSD + "integer", "double", XSD + "double", "boolean", XSD + "boolean", "timestamp", XSD + "dateTime")])
    parts = [
        st(names, F.col("class"), RDF_TYPE, F.lit(OWL + "Class")), st(parent, F.col("class"), SUBCLASS, F.col("parent")),
        st(links_, link, RDF_TYPE, F.lit(OWL + "ObjectProperty")), st(links_, link, DOMAIN, F.col("src")), st(links_, link, RANGE, F.col("dst")),
        st(properties, prop, RDF_TYPE, F.lit(OWL + "DatatypeProperty")), st(properties, prop, DOMAIN, F.col("class")), st(properties, prop, RANGE, back[F.col("dtype")]),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.union(x)
    return out.distinct()

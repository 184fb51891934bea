"""Entity resolution: canonical names, guards, merging, remapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

# Pairs of names that are never one entity.
ANTONYMS = (
    ("encryption", "decryption"), ("encrypt", "decrypt"), ("symmetrical encryption", "symmetrical decryption"), ("symmetric encryption", "symmetric decryption"),
    ("asymmetric encryption", "asymmetric decryption"), ("synchronous", "asynchronous"), ("synchronous job processing", "asynchronous job processing"), ("http", "https"),
    ("sender", "receiver"), ("client", "server"), ("input", "output"), ("read", "write"), ("request", "response"), ("start", "stop"), ("activate", "deactivate"), ("enable", "disable"),
)
# Spellings of labels.
LABEL_ALIASES = {
    "documentref": "DocumentRef", "document_ref": "DocumentRef", "configparameter": "ConfigParameter", "config_parameter": "ConfigParameter", "standardref": "StandardRef",
    "standard_ref": "StandardRef", "functionalcluster": "FunctionalCluster", "functional_cluster": "FunctionalCluster", "changerecord": "ChangeRecord", "change_record": "ChangeRecord",
    "specificationitem": "SpecificationItem", "specification_item": "SpecificationItem", "securityfeature": "SecurityFeature", "security_feature": "SecurityFeature",
    "datatype": "DataType", "data_type": "DataType", "testspecification": "TestSpecification", "testcase": "TestCase", "organisation": "Organization",
}
PREFIXED = r"(?i)^(Concept|Module|Function|System|Entity|Type|Service)_(.+)$"


def normal_label(label: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in LABEL_ALIASES.items() for x in pair])
    return F.coalesce(F.element_at(names, F.lower(label)), label)


def are_antonyms(a: Column, b: Column, pairs: tuple = ANTONYMS) -> Column:
    """Whether one name has one word of a pair in it and the other name the other; equal names never are."""
    x, y = F.lower(F.trim(a)), F.lower(F.trim(b))
    some = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in pairs])
    return (x != y) & F.exists(some, lambda t: (F.contains(x, t["p"]) & F.contains(y, t["q"])) | (F.contains(x, t["q"]) & F.contains(y, t["p"])))


def canonical(nodes: DataFrame, names: DataFrame, key: str, name: str) -> DataFrame:
    """``nodes`` with ``canonical``, from ``names (alias, canonical)`` by the lower-case name, else the name itself. A small ``names`` is broadcast by its size."""
    by = names.select(F.lower("alias").alias("__wl_alias"), F.col("canonical").alias("canonical")).dropDuplicates(["__wl_alias"])
    return nodes.join(by, F.lower(F.trim(F.col(name))) == F.col("__wl_alias"), "left").drop("__wl_alias").withColumn("canonical", F.coalesce("canonical", F.col(name)))


def merge_clusters(nodes: DataFrame, cluster: list[str], key: str, name: str) -> DataFrame:
    """``(cluster, id, name, aliases, members)``: the first node by key gives the id, the most frequent name (ties to the smallest) the name; aliases are distinct and sorted."""
    names = nodes.groupBy(*cluster, name).agg(F.count("*").alias("n"), F.min(key).alias("id"))
    best = F.max_by(name, F.struct("n", F.col("back"))).alias("name")
    back = names.withColumn("back", F.row_number().over(Window.partitionBy(*cluster).orderBy(F.desc(name))))
    return back.groupBy(*cluster).agg(F.min("id").alias("id"), best, F.array_sort(F.collect_set(name)).alias("aliases"), F.sum("n").alias("members"))


def prefix_pairs(nodes: DataFrame, key: str, name: str) -> DataFrame:
    """``(prefixed, plain)``: keys of nodes named ``Concept_X`` and the like, and of nodes named ``X``, in any case."""
    plain = nodes.select(F.col(key).alias("plain"), F.lower(name).alias("__wl_name"))
    tagged = nodes.select(F.col(key).alias("prefixed"), F.lower(F.regexp_extract(name, PREFIXED, 2)).alias("__wl_name")).filter("__wl_name <> ''")
    return tagged.join(plain, "__wl_name").filter("prefixed <> plain").select("prefixed", "plain")


def follow(aliases: DataFrame, rounds: int = 32) -> DataFrame:
    """``(old, new)`` with chains followed to their end by doubling; a cycle ends at its smallest member."""
    now = written(aliases.select("old", "new").filter("old <> new").dropDuplicates(["old"]), "aliases")
    for _ in range(rounds):
        on = now.select(F.col("old").alias("new"), F.col("new").alias("further"))
        step = written(now.join(on, "new", "left").select("old", "new", F.col("further").isNotNull().alias("moved"), F.coalesce("further", "new").alias("to")), "aliases")
        if step.filter("moved AND to <> old").isEmpty():
            return step.select("old", F.when(F.col("moved"), F.least("old", "to", "new")).otherwise(F.col("to")).alias("new")).filter("old <> new")
        now = step.select("old", F.when(F.col("to") == F.col("old"), F.least("old", "new")).otherwise(F.col("to")).alias("new")).filter("old <> new")
    return now


def remap_edges(edges: DataFrame, aliases: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``edges`` with their ends renamed by ``aliases (old, new)``; loops that come of it, and repeats, go."""
    a, b = (aliases.select(F.col("old").alias(e), F.col("new").alias(f"__wl_{e}")) for e in (src, dst))
    out = edges.join(a, src, "left").join(b, dst, "left").withColumn(src, F.coalesce(f"__wl_{src}", src)).withColumn(dst, F.coalesce(f"__wl_{dst}", dst))
    return out.filter(F.col(src) != F.col(dst)).select(*edges.columns).distinct()


def normal_name(name: Column) -> Column:
    """The form that spellings of one name share: no type in front, words apart, lower case, blanks collapsed."""
    bare = F.coalesce(F.nullif(F.regexp_extract(F.trim(name), PREFIXED, 2), F.lit("")), F.trim(name))
    apart = F.regexp_replace(F.regexp_replace(bare, r"[_\-\s]+", " "), r"(?<=[a-z0-9])(?=[A-Z])", " ")
    return F.lower(F.trim(apart))


def spelling_names(nodes: DataFrame, name: str) -> DataFrame:
    """``(alias, canonical)``: of the spellings of each normal name the most frequent one, ties to the smallest, for those that have several."""
    counts = nodes.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("alias")).agg(F.count("*").alias("n")).withColumn("form", normal_name(F.col("alias")))
    best = counts.groupBy("form").agg(F.min_by("alias", F.struct(-F.col("n"), F.col("alias"))).alias("canonical"), F.count("*").alias("spellings")).filter("spellings > 1")
    return counts.join(best, "form").filter("alias <> canonical").select("alias", "canonical")


def merge_properties(nodes: DataFrame, cluster: list[str], order: str, properties: list[str], name: str) -> DataFrame:
    """``(cluster, properties, aliases)``: of each property the last value, in order, that is not null; names once each in order of first sight."""
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in properties]
    seen = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), F.col(name).alias("n")))), lambda x: x["n"])
    return nodes.groupBy(*cluster).agg(*last, F.array_distinct(seen).alias("aliases"))


def override(nodes: DataFrame, key: list[str], order: str, name: str, aliases: str) -> DataFrame:
    """The first node of each key, in order, with the names and aliases of the others added to its own."""
    first = nodes.groupBy(*key).agg(F.min_by(F.struct(*[c for c in nodes.columns if c not in (*key, aliases)]), order).alias("f"), F.array_sort(F.collect_list(F.struct(F.col(order), F.array_append(F.coalesce(aliases, F.array().cast("array<string>")), F.col(name)).alias("a")))).alias("all"))
    every = F.array_distinct(F.flatten(F.transform("all", lambda x: x["a"])))
    return first.select(*key, "f.*", F.array_remove(every, F.col(f"f.{name}")).alias(aliases)).select(*nodes.columns)


def merge_prefixed(nodes: DataFrame, edges: DataFrame, key: str = "id", name: str = "name") -> tuple[DataFrame, DataFrame]:
    """Nodes named ``Concept_X`` and the like become the first node named ``X``; edges move."""
    aliases = prefix_pairs(nodes, key, name).groupBy(F.col("prefixed").alias("old")).agg(F.min("plain").alias("new"))
    return nodes.join(aliases.select(F.col("old").alias(key)), key, "left_anti"), remap_edges(edges, follow(aliases))


def guarded(names: DataFrame, key: str, name: str):
    """For ``similar_components``: takes pairs of antonyms out."""

    def allowed(pairs: DataFrame) -> DataFrame:
        a, b = (names.select(F.col(key).alias(c), F.col(name).alias(f"__wl_{c}")) for c in ("a", "b"))
        return pairs.join(a, "a").join(b, "b").filter(~F.coalesce(are_antonyms(F.col("__wl_a"), F.col("__wl_b")), F.lit(False))).select(*pairs.columns)

    return allowed

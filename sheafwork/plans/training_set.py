"""Labelled dataset: join, caption, encode, split, write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.labels import key_violations, label_codes, label_join_2021, label_join_2022, with_names
from ..operators.split import with_split
from ..schemas import LABELLED
from ..sinks.files import with_row_index, write_csv, write_jsonl
from ..staging import staged


def training_set(joined: DataFrame, row_id: str = "id") -> DataFrame:
    """Adds caption, scientific name, label code and split to joined rows.

    The join result is written once, because three readers follow: names, cut, and the rows
    themselves, each with columns of its own. The codes are written too, which tells Spark their
    size: small ones are broadcast, large ones joined by exchange.
    """
    rows = staged(joined, "joined")
    named = with_names(rows)
    codes = staged(label_codes(named), "codes")
    return with_split(named.join(codes, "scientific_name", "left"), row_id, of=rows)


def labelled_columns(rows: DataFrame, *extra: str) -> DataFrame:
    """Columns and names of the written files, after any ``extra`` ones."""
    names = {"scientific_name": "scientificName", "code": "scientificNameEncoded"}
    return rows.withColumnsRenamed(names).select(*extra, *LABELLED.fieldNames())


def build(star: dict[str, DataFrame], year: int) -> DataFrame:
    """Training set of one year's bundle frames (``sources.bundle.star_2021`` or ``star_2022``)."""
    join = {2021: label_join_2021, 2022: label_join_2022}[year]
    return training_set(join(star["annotations"], star["images"], star["categories"], star["institutions"]))


def write_dataset(rows: DataFrame, folder: str, year: int) -> None:
    """``train_<year>`` and ``val_<year>`` as CSV (with row index) and JSON lines (without)."""
    indexed = with_row_index(rows, ["id"])
    for part in ("train", "val"):
        chosen = indexed.filter(F.col("split") == part)
        write_csv(labelled_columns(chosen, "row_index"), f"{folder}/{part}_{year}.csv", index="row_index")
        write_jsonl(labelled_columns(chosen), f"{folder}/{part}_{year}.json")


# Keys by which an annotation looks up its image, category and institution.
KEYS = {
    2021: {"images": "id", "categories": "category_id", "institutions": "institution_id"},
    2022: {"images": "image_id", "categories": "category_id", "institutions": "institution_id"},
}


def account(star: dict[str, DataFrame], rows: DataFrame, year: int) -> DataFrame:
    """``name, n``: annotations read, written and dropped for want of a partner, how many lack one in each dimension, and
    written rows without a species (names of one word). ``annotations`` is the sum of ``written`` and ``dropped``."""
    facts = star["annotations"]
    missing = key_violations(facts, {name: (key, star[name]) for name, key in KEYS[year].items()})
    by_dimension = missing.select(F.concat(F.lit("without "), "dimension").alias("name"), F.col("n_missing").alias("n"))
    read = facts.agg(F.count("*").alias("read"))
    done = rows.agg(F.count("*").alias("written"), F.count_if(F.col("species").isNull()).alias("unnamed"))
    # One row on either side.
    both = read.join(F.broadcast(done), F.lit(True))
    totals = both.select(
        F.explode(
            F.array(
                F.struct(F.lit("annotations").alias("name"), F.col("read").alias("n")),
                F.struct(F.lit("written").alias("name"), F.col("written").alias("n")),
                F.struct(F.lit("dropped").alias("name"), (F.col("read") - F.col("written")).alias("n")),
                F.struct(F.lit("without species").alias("name"), F.col("unnamed").alias("n")),
            )
        ).alias("_t")
    )
    return totals.select("_t.name", "_t.n").unionByName(by_dimension)


def write_year(star: dict[str, DataFrame], folder: str, year: int) -> DataFrame:
    """The whole job of a year: metadata CSV of the join, train and validation files, and ``account`` as JSON lines
    (returned as well). Annotations without a partner are dropped, and counted there."""
    rows = staged(build(star, year), "training-set")
    metadata = with_row_index(rows.select("image_id", "filename", "species", "genus", "family", "institution"), ["image_id", "filename"])
    write_csv(metadata, f"{folder}/train_{year}_metadata.csv", index="row_index")
    write_dataset(rows, folder, year)
    counts = staged(account(star, rows, year), "account")
    write_jsonl(counts.coalesce(1), f"{folder}/account_{year}.json")
    return counts

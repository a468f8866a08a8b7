"""Maintenance manuals: sections by marker, labelled fields, ordered steps (TX2-TX5, SF16-SF18, UD3).

A manual is a text with a header and task sections.  Each section starts
with a ``TASK nn-nn-nn`` marker; ``Label: value`` fields may wrap over lines
and end at the next known label, at the first step, or at the end.
Everything is a regular-expression column; nothing loops over documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wingspan.operators.text import collapse_ws

# The field labels of a task section.
LABELS = ["Fault Code", "Aircraft Type", "ATA Chapter", "System", "Part Name", "Part Number", "Related Parts",
          "Symptoms", "Probable Causes", "Limits", "Corrective Action", "Torque Values", "Return to Service"]
SECTION_MARKER = r"(?=TASK [0-9]{2}-[0-9]{2}-[0-9]{2})"
_END = r"(?=\n\s*(?:" + "|".join(LABELS) + r"):|\n\s*Step [0-9]+\.|\z)"


def labelled(body: Column, label: str) -> Column:
    """SF16: the value after ``label:``, white space collapsed; null where the label is absent."""
    pattern = rf"(?s){label}:\s*(.+?){_END}"
    return F.when(body.rlike(pattern), collapse_ws(F.regexp_extract(body, pattern, 1)))


def steps(body: Column) -> Column:
    """SF18: the texts of the numbered steps, in order."""
    found = F.regexp_extract_all(
        body, F.lit(r"(?s)Step [0-9]+\.\s*(.+?)(?=\n\s*Step [0-9]+\.|\n\s*Torque Values:|\z)"), F.lit(1))
    return F.transform(found, collapse_ws)


def task_sections(manuals: DataFrame) -> DataFrame:
    """SF17 + TX2 + TX3: one row per section, the header's engine on each.

    ``manuals`` has manual_name, source_path and full_text.
    """
    parts = F.split("full_text", SECTION_MARKER)
    engine = F.regexp_extract(F.get(parts, F.lit(0)), r"Engine:\s*([^.]+)\.", 1)
    return (manuals.select("manual_name", "source_path", F.when(engine != "", engine).alias("engine"),
                           F.posexplode(parts).alias("section", "part"))
            .filter("section > 0").withColumn("content", F.btrim("part", F.lit(" \n\t\r"))).drop("part"))


def manual_chunks(manuals: DataFrame) -> DataFrame:
    """TX4 + TX5: the 19-column chunk record of every task section."""
    s = task_sections(manuals)
    body = F.col("content")
    field = {x: labelled(body, x) for x in LABELS}
    or_empty = lambda x: F.coalesce(field[x], F.lit(""))
    title = collapse_ws(F.regexp_extract(body, r"(?s)^(TASK .+?)(?=\n\s*Fault Code:|\z)", 1))
    ata = F.regexp_extract(body, r"^TASK ([0-9]{2}-[0-9]{2}-[0-9]{2})", 1)
    return s.select(
        F.concat_ws("|", field["Aircraft Type"], ata).alias("chunk_id"), "manual_name", "source_path",
        field["Aircraft Type"].alias("aircraft_type"), "engine", ata.alias("ata_chapter"), title.alias("task_title"),
        field["Fault Code"].alias("fault_code"), field["System"].alias("system"),
        field["Part Name"].alias("part_name"), field["Part Number"].alias("part_number"),
        or_empty("Related Parts").alias("related_parts"), or_empty("Symptoms").alias("symptoms"),
        or_empty("Probable Causes").alias("probable_causes"), or_empty("Limits").alias("limits"),
        F.array_join(steps(body), "\n").alias("corrective_steps"), or_empty("Torque Values").alias("torque_values"),
        "content",
        F.concat(title, F.lit(". Aircraft "), or_empty("Aircraft Type"), F.lit(". System "), or_empty("System"),
                 F.lit(". Part "), or_empty("Part Name"), F.lit(" "), or_empty("Part Number"), F.lit(". Fault "),
                 or_empty("Fault Code"), F.lit(".\n"), body).alias("search_text"))


def part_manuals(parts: DataFrame) -> DataFrame:
    """Manuals written from the part table: a header and two task sections per part, with wrapped lines."""
    key = F.col("p_partkey")
    pair = lambda k: F.lpad(((key * k) % 100).cast("string"), 2, "0")
    task = lambda n: F.concat(
        F.lit("TASK "), pair(1), F.lit("-"), pair(7), F.lit(f"-0{n} Inspect "), F.col("p_name"),
        F.lit("\n  for wear\n Fault Code: F"), (key % 10).cast("string"), F.lit("\n Aircraft Type: "), F.col("p_type"),
        F.lit("\nSystem: fuel\n   and oil\nPart Name: "), F.col("p_name"), F.lit("\nPart Number: PN-"),
        key.cast("string"), F.lit("\nSymptoms: noise\nCorrective Action:\n Step 1. Remove "), F.col("p_name"),
        F.lit(f"\n Step 2. Fit\n size {n} "), F.col("p_size").cast("string"), F.lit("\n Torque Values: "),
        F.col("p_size").cast("string"), F.lit(" Nm\n"))
    return parts.select(
        F.concat(F.lit("manual_"), key.cast("string"), F.lit(".txt")).alias("manual_name"),
        F.concat(F.lit("/manuals/"), key.cast("string")).alias("source_path"),
        F.concat(F.lit("Manual\nEngine: "), F.col("p_brand"), F.lit(".\n"), task(1), task(2)).alias("full_text"))

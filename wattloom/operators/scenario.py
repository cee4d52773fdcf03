"""Scenario preparation: nested JSON to the annual long table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.numbers import mmbtu_to_kwh, zero_if_null
from wattloom.functions.text import col, cols, sector_of
from wattloom.operators.joins import prefixed, require_unique, right
from wattloom.operators.reconcile import conservation

# Names used in scenario files.
CATEGORIES = "Markets and Savings (by Category)"
WEIGHTS_SUFFIX = "Gap Weights"
EFFICIENT = "Efficient Energy Use (MMBtu)"
MEASURE = "Efficient Energy Use, Measure (MMBtu)"
ENVELOPE = "Efficient Energy Use, Measure-Envelope (MMBtu)"
BASELINE = "Baseline Energy Use (MMBtu)"

TEXT_MAP = "map<string,string>"
# adoption scenario > metric > region > building type > end use > rest (text)
CATEGORY_LEVELS = ("adoption_scn", "metric", "reg", "bldg_type", "end_use")
CATEGORY_MAP = "map<string," * len(CATEGORY_LEVELS) + "string" + ">" * len(CATEGORY_LEVELS)


def measure_objects(
    documents: DataFrame, text: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per measure of a scenario document: name and the measure's JSON.

    The last top-level key of a document describes the run and is skipped.  A
    document is parsed at its top level by the task that read it; the measures are
    then dealt out, so the nested text of one document is parsed by many tasks.
    A text that is not a complete JSON object fails the job.
    """
    names = F.json_object_keys(col(text))
    parsed = documents.filter(col(text).isNotNull()).select(
        *cols(keep),
        _parsed(col(text), TEXT_MAP, "document").alias("__doc"),
        F.element_at(names, -1).alias("__last"),
    )
    measures = parsed.select(*cols(keep), col("__last"), F.explode("__doc").alias("meas", "__text"))
    return (
        measures.filter(col("meas") != col("__last"))
        .select(*cols([*keep, "meas"]), col("__text"))
        .repartition(*cols([*keep, "meas"]))
        .select(*cols([*keep, "meas"]), _parsed(col("__text"), TEXT_MAP, "measure").alias("body"))
    )


def _parsed(text: Column, schema: str, what: str) -> Column:
    """JSON text as ``schema``; text that does not parse is an error, never a NULL.

    Whole documents are checked by their keys as well: the parser would keep the
    part of a truncated object that it has read.
    """
    bad = F.raise_error(F.concat(F.lit(f"not a JSON object ({what}): "), F.substring(text, 1, 200)))
    whole = F.get_json_object(text, "$").isNotNull()
    value = F.when(whole, F.from_json(text, schema))
    return F.when(text.isNotNull() & (F.trim(text) != "null"), F.coalesce(value, bad.cast(schema)))


def _number(text: Column, where: Column) -> Column:
    """A leaf as a number; ``NaN`` is one, ``null`` is NULL, other text is an error."""
    value = text.try_cast("double")
    bad = F.raise_error(F.concat(F.lit("not a number: "), text, F.lit(" in "), where))
    return F.when(text.isNotNull() & (text != "null"), F.coalesce(value, bad.cast("double")))


def measure_bodies(members: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``measure_objects`` from measures that were cut out already (``sources.ranges``)."""
    return members.select(*cols([*keep, "meas"]), _parsed(col(text), TEXT_MAP, "measure").alias("body"))


def flatten_scenario(
    documents: DataFrame, text: str = "value", keep: Sequence[str] = (), cut: bool = False
) -> DataFrame:
    """Rows (measure, adoption, metric, region, type, end use, fuel, year, value).

    Paths without a fuel level belong to electricity: the level after the end
    use then maps years straight to numbers.  Both depths may occur side by side.
    With ``cut`` a row of ``documents`` is one measure (see ``measure_bodies``).
    """
    bodies = measure_bodies if cut else measure_objects
    out = bodies(documents, text, keep).select(
        *cols([*keep, "meas"]),
        _parsed(F.try_element_at(col("body"), F.lit(CATEGORIES)), CATEGORY_MAP, "categories").alias(
            "__rest"
        ),
    )
    done = [*keep, "meas"]
    for level in CATEGORY_LEVELS:
        out = out.select(*cols(done), F.explode(col("__rest")).alias(level, "__rest"))
        done.append(level)
    leaf = _parsed(col("__rest"), TEXT_MAP, "end use")
    out = out.select(*cols(done), F.explode(leaf).alias("__key", "__leaf"))
    by_fuel = _parsed(col("__leaf"), TEXT_MAP, "fuel")
    by_year = F.create_map(col("__key"), col("__leaf"))
    has_fuel = F.ltrim(col("__leaf")).startswith("{")
    return out.select(
        *cols(done),
        F.when(has_fuel, col("__key")).otherwise(F.lit("Electric")).alias("fuel"),
        F.explode(F.when(has_fuel, by_fuel).otherwise(by_year)).alias("year", "value"),
    ).withColumns({"year": col("year").cast("int"), "value": _number(col("value"), col("meas"))})


def gap_weights(
    documents: DataFrame, text: str = "value", keep: Sequence[str] = (), key: str | None = None, cut: bool = False
) -> DataFrame:
    """(measure, building type, year) -> share not covered by the building models.

    ``key`` is the name under which a measure holds its weights.  Without it that is
    the one name ending in ``WEIGHTS_SUFFIX``; several such names are an error.
    With ``cut`` a row of ``documents`` is one measure (see ``measure_bodies``).
    """
    bodies = (measure_bodies if cut else measure_objects)(documents, text, keep)
    named = F.map_filter(
        col("body"), lambda k, _: k == key if key else k.endswith(WEIGHTS_SUFFIX)
    )
    many = F.raise_error(F.concat(F.lit("several weight tables in "), col("meas")))
    texts = F.when(F.size(named) > 1, many.cast("map<string,string>")).otherwise(named)
    weights = bodies.select(*cols([*keep, "meas"]), F.explode(texts).alias("__key", "__text"))
    types = weights.select(
        *cols([*keep, "meas"]),
        F.explode(_parsed(col("__text"), "map<string,map<string,string>>", "weights")).alias(
            "bldg_type", "__years"
        ),
    )
    return types.select(
        *cols([*keep, "meas", "bldg_type"]),
        F.explode(col("__years")).alias("year", "gap_weight"),
    ).withColumns(
        {"year": col("year").cast("int"), "gap_weight": _number(col("gap_weight"), col("meas"))}
    )


def _scenario_baselines(parts: Sequence[DataFrame], value: str, origin: str) -> DataFrame:
    """Baseline rows of every scenario, equal keys of one scenario summed.

    ``__part`` is the scenario's place in ``parts``; rows without an ``origin`` are
    their own measure's.
    """
    out = None
    for i, part in enumerate(parts):
        one = part if origin in part.columns else part.withColumn(origin, col("meas"))
        keys = [c for c in one.columns if c != value]
        # the scenario is a literal of each part, so equal keys of two scenarios stay apart
        sums = (
            one.filter(col("turnover").eqNullSafe("baseline"))
            .groupBy(*cols(keys))
            .agg(F.sum(col(value)).alias(value))
            .withColumn("__part", F.lit(i))
        )
        out = sums if out is None else out.unionByName(sums)
    return out


def merge_baselines(
    parts: Sequence[DataFrame], value: str = "state_ann_kwh", origin: str = "origin"
) -> DataFrame:
    """One baseline for all scenarios, each a table of ``parts``; other rows united.

    Equal keys within a scenario are different energy and add up.  Across scenarios
    the baseline of a document's measure (``origin``, dropped here) counts once: where
    scenarios disagree the one with the smallest value is taken, with both halves of
    its split, whatever their order; ``baseline_conflicts`` lists such keys.  What
    several measures have under one name, such as the unmodelled energy, adds up.
    """
    names = [c for c in parts[0].columns if c != origin]
    keys = [c for c in names if c != value]
    whole = [c for c in keys if c != "meas"]
    choice = F.struct(
        F.sum(col(value)).isNull().alias("missing"),
        F.sum(col(value)).alias("total"),
        F.sort_array(F.collect_list(F.struct(col("meas"), col(value)))).alias("rows"),
    )
    chosen = (
        _scenario_baselines(parts, value, origin)
        .groupBy(*cols([*whole, origin, "__part"]))
        .agg(choice.alias("__choice"))
        .groupBy(*cols([*whole, origin]))
        .agg(F.min("__choice").alias("__choice"))
        .select(*cols(whole), F.inline(col("__choice")["rows"]))
    )
    agreed = chosen.groupBy(*cols(keys)).agg(F.sum(col(value)).alias(value))
    out = agreed.select(*cols(names))
    for part in parts:
        out = out.unionByName(part.filter(~col("turnover").eqNullSafe("baseline")).select(*cols(names)))
    return out


def baseline_conflicts(
    parts: Sequence[DataFrame], value: str = "state_ann_kwh", origin: str = "origin"
) -> DataFrame:
    """Baseline keys whose values differ between scenarios by over one part in a million."""
    every = _scenario_baselines(parts, value, origin)
    keys = [c for c in every.columns if c not in (value, "__part")]
    spread = every.groupBy(*cols(keys)).agg(
        F.min(col(value)).alias("least"), F.max(col(value)).alias("most")
    )
    size = F.greatest(F.abs(col("least")), F.abs(col("most")))
    return spread.filter(col("most") - col("least") > 1e-6 * size)


def metric_columns(
    rows: DataFrame, index: Sequence[str], metrics: dict[str, str]
) -> DataFrame:
    """One column per metric: its sum, 0 for all-missing values, NULL if absent."""
    return rows.groupBy(*cols(index)).agg(
        *[
            F.sum(F.when(col("metric") == m, zero_if_null(col("value")))).alias(name)
            for m, name in metrics.items()
        ]
    )


def _stage_values(component: Column) -> tuple[Column, Column]:
    """(original, measure) kWh of one component of a package."""
    whole, part = col("efficient_mmbtu"), col("efficient_measure_mmbtu")
    env = col("efficient_measure_env_mmbtu")
    equipment = component == "equipment"
    both = component == "equipment + env"
    return (
        F.when(equipment, mmbtu_to_kwh(whole - part)).when(both, F.lit(0.0)),
        F.when(equipment, mmbtu_to_kwh(part - env)).when(both, mmbtu_to_kwh(env)),
    )


def _single_values() -> tuple[Column, Column]:
    """(original, measure) kWh of a measure that is one technology."""
    whole, part = col("efficient_mmbtu"), col("efficient_measure_mmbtu")
    return mmbtu_to_kwh(whole - part), mmbtu_to_kwh(part)


def package_split(
    wide: DataFrame, package_map: DataFrame, index: Sequence[str]
) -> DataFrame:
    """Original and measure kWh per technology, packages split into components.

    A row without an envelope value is one technology.  A row with one is joined
    to the component rows of its package: the equipment component carries what
    the package saves beyond the envelope, the other one the envelope part.  A
    package the map does not name keeps its row with no name and no energy.
    """
    packaged = col("efficient_measure_env_mmbtu").isNotNull()
    joined = wide.join(
        prefixed(package_map, ["meas"]), (col("meas") == right("meas")) & packaged, "left"
    )
    split, single = _stage_values(col("component")), _single_values()
    return joined.select(
        *[
            F.when(packaged, col("meas_separated")).otherwise(col("meas")).alias("meas")
            if n == "meas"
            else col(n)
            for n in index
        ],
        F.when(packaged, split[0]).otherwise(single[0]).alias("original_ann"),
        F.when(packaged, split[1]).otherwise(single[1]).alias("measure_ann"),
    )


def annual_long(
    rows: DataFrame,
    package_map: DataFrame | None,
    turnover: str,
    run: str,
    include_baseline: bool = True,
    include_bldg_type: bool = True,
    include_origin: bool = False,
) -> DataFrame:
    """Flattened scenario rows -> (keys, stage, kWh, scenario, sector, run).

    All metrics are summed in one aggregation and every output row of a key
    (stages, package components, baseline) is an array element of that key's
    row, so the scenario is read once.  Baseline energy of a package goes under
    the name of its equipment component.  ``package_map=None`` means the
    scenario has no envelope packages.  ``include_origin`` adds ``origin``, the
    measure's name in the document.
    """
    index = ["meas", "reg", *(["bldg_type"] if include_bldg_type else []), "end_use", "fuel", "year"]
    metrics = {EFFICIENT: "efficient_mmbtu", MEASURE: "efficient_measure_mmbtu"}
    if package_map is not None:
        metrics[ENVELOPE] = "efficient_measure_env_mmbtu"
    live = list(metrics.values())
    if include_baseline:
        metrics[BASELINE] = "baseline_mmbtu"
    wide = metric_columns(rows.filter(col("metric").isin(*metrics)), index, metrics)
    single = _entries(col("meas"), _single_values(), turnover)
    names = F.array(col("meas"))
    if package_map is None:
        staged = single
    else:
        parts = package_map.groupBy("meas").agg(
            F.collect_list(F.struct("meas_separated", "component")).alias("__parts")
        )
        wide = wide.join(parts, "meas", "left")
        unnamed = F.array(
            F.struct(
                F.lit(None).cast("string").alias("meas_separated"),
                F.lit(None).cast("string").alias("component"),
            )
        )
        split = F.flatten(
            F.transform(
                F.coalesce(col("__parts"), unnamed),
                lambda p: _entries(
                    p["meas_separated"], _stage_values(p["component"]), turnover
                ),
            )
        )
        staged = F.when(col("efficient_measure_env_mmbtu").isNull(), single).otherwise(split)
        equipment = F.transform(
            F.filter(col("__parts"), lambda p: p["component"] == "equipment"),
            lambda p: F.coalesce(p["meas_separated"], col("meas")),
        )
        names = F.when(F.size(equipment) > 0, equipment).otherwise(names)
    present = F.coalesce(*cols(live)).isNotNull()
    groups = [F.when(present, staged)]
    if include_baseline:
        energy = mmbtu_to_kwh(col("baseline_mmbtu"))
        based = F.transform(
            names, lambda n: _entry(n, "original_ann", energy, "baseline")
        )
        groups.append(F.when(col("baseline_mmbtu").isNotNull(), based))
    every = F.flatten(F.filter(F.array(*groups), lambda g: g.isNotNull()))
    rest = [n for n in index if n != "meas"]
    origin = [col("meas").alias("origin")] if include_origin else []
    out = wide.select(*cols(rest), *origin, F.inline(every))
    return out.select(
        *cols([*index, "tech_stage", "state_ann_kwh", "turnover"]),
        sector_of(col("meas")).alias("sector"),
        F.lit(run).alias("run_id"),
        *cols(["origin"] if include_origin else []),
    )


def _entry(name: Column, stage: str, energy: Column, turnover: str) -> Column:
    return F.struct(
        name.alias("meas"),
        F.lit(stage).alias("tech_stage"),
        energy.alias("state_ann_kwh"),
        F.lit(turnover).alias("turnover"),
    )


def _entries(name: Column, values: tuple[Column, Column], turnover: str) -> Column:
    return F.array(
        _entry(name, "original_ann", values[0], turnover),
        _entry(name, "measure_ann", values[1], turnover),
    )


def weighted_split(
    long: DataFrame,
    weights: DataFrame,
    keys: Sequence[str] = ("meas", "bldg_type", "year"),
    value: str = "state_ann_kwh",
    weight: str = "gap_weight",
    name: str = "meas",
    split_name: str = "Gap",
    affected=None,
) -> DataFrame:
    """Move the weighted part of the affected rows to rows named ``split_name``.

    Every affected row becomes two whose values add up to it; a missing weight
    is 0.  Weights must be unique per key.
    """
    if affected is None:
        affected = (col("sector") == "com") & (col("fuel") == "Electric")
    hit = F.coalesce(affected, F.lit(False))
    unique = require_unique(weights.select(*cols([*keys, weight])), keys, "split weights")
    # Rows that are not affected pass through the same join: the table is read
    # once and stays in one branch.
    joined = long.join(unique, list(keys), "left")
    w = zero_if_null(col(weight))

    def half(label: Column, amount: Column) -> Column:
        return F.struct(label.alias("__n"), amount.alias("__v"))

    pieces = F.when(
        hit,
        F.array(
            half(col(name), (F.lit(1.0) - w) * col(value)),
            half(F.lit(split_name), w * col(value)),
        ),
    ).otherwise(F.array(half(col(name), col(value))))
    names = long.columns
    rest = [n for n in names if n not in (name, value)]
    out = joined.select(*cols(rest), F.inline(pieces))
    return out.select(
        *[
            col("__n").alias(n) if n == name else col("__v").alias(n) if n == value else col(n)
            for n in names
        ]
    )


def split_conservation(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    value: str = "state_ann_kwh",
    affected=None,
    scopes: tuple[str, str] = ("ALL_ROWS", "COM_ELECTRIC_ONLY"),
) -> DataFrame:
    """Before/after comparison over all rows and over the affected rows.

    ``affected`` must depend on the keys alone.
    """
    if affected is None:
        affected = (col("sector") == "com") & (col("fuel") == "Electric")
    hit = F.coalesce(affected, F.lit(False))
    return conservation(
        before, after, keys, value, {scopes[0]: F.lit(True), scopes[1]: hit}
    )

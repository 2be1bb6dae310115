"""Policy decisions as joins and ordered conditions over tables of requests.

Rule tables are DataFrame arguments. A missing rule row always gives the refusing value. No join
is hinted: a rule table is small enough to be broadcast when its measured size says so, and is
shuffled like any other table when it is not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import constants as C
from ledgerlens.functions.sqltext import lit
from ledgerlens.session import cut_lineage, fixed_table


def _ranked(column: Column, ranks: Mapping[str, int]) -> Column:
    """Rank of a value, null when unknown; comparisons with null refuse."""
    expr = F.lit(None).cast("int")
    for name, rank in ranks.items():
        expr = F.when(column == name, F.lit(rank)).otherwise(expr)
    return expr


def role_rank(column: Column) -> Column:
    return _ranked(column, C.ROLE_RANK)


def level_rank(column: Column) -> Column:
    return _ranked(column, C.LEVEL_RANK)


def yes(column: Column) -> Column:
    return F.coalesce(column, F.lit(False))


def has_capability(role: Column, capability: Column) -> Column:
    """Capability check against the fixed role model."""
    found = F.lit(False)
    for name, caps in C.ROLE_CAPABILITIES.items():
        found = F.when(role == name, capability.isin(list(caps))).otherwise(found)
    return yes(found)


def role_capabilities(spark: SparkSession) -> DataFrame:
    """The fixed role model as a rule table ``(role, capability)``."""
    rows = [(role, cap) for role, caps in C.ROLE_CAPABILITIES.items() for cap in caps]
    return fixed_table(spark, rows, "role string, capability string")


# --- function effects --------------------------------------------------------------------------


def _matches(bare: Column, exact: Sequence[str], prefixes: Sequence[str], suffixes: Sequence[str] = ()) -> Column:
    found = bare.isin(list(exact)) if exact else F.lit(False)
    for prefix in prefixes:
        found = found | bare.startswith(prefix)
    for suffix in suffixes:
        found = found | bare.endswith(suffix)
    return found


def _name_effects(bare: Column) -> Column:
    """Side effects implied by the bare name alone."""
    kinds = [F.when(_matches(bare, exact, prefixes), kind) for kind, exact, prefixes in C.NAME_FAMILIES]
    return F.filter(F.array(*kinds), lambda k: k.isNotNull())


def function_effects(
    refs: DataFrame,
    catalog: DataFrame | None,
    name: str = "name",
    safe: Sequence[str] = C.SAFE_CATALOG_FUNCTIONS,
) -> DataFrame:
    """Add ``qualified_name, effect, side_effects, resolved`` to every function reference.

    ``catalog`` has ``schema, name, provolatile, prosecdef, visible``; over overloads the least
    safe verdict counts. Without a catalog, or for a name it lacks, only harmless built-in names
    resolve. Verdicts are worked out once per distinct name and joined back.
    """
    names = (
        refs.select(F.lower(name).alias("_name"))
        .distinct()
        .withColumn("_q", F.when(qualified_of("_name"), F.split("_name", r"\.")[0]))
        .withColumn("_bare", F.when(F.col("_q").isNotNull(), F.split("_name", r"\.")[1]).otherwise(F.col("_name")))
    )
    bare = F.col("_bare")
    names = names.withColumns(
        {
            "_kinds": _name_effects(bare),
            "_denied": _matches(bare, C.DENIED_FUNCTIONS, C.DENIED_PREFIXES, C.DENIED_SUFFIXES),
            "_safe": bare.isin(list(safe)),
        }
    ).withColumn("_danger", F.col("_denied") | (F.size("_kinds") > 0))

    if catalog is None:
        graded = names.withColumns(
            {"_sev": F.lit(None).cast("int"), "_bad": F.lit(None).cast("boolean"), "_found": F.lit(None).cast("string")}
        )
    else:
        system = F.col("c.schema").isin("pg_catalog", "information_schema")
        harmless = (system & ~(F.col("_danger") | F.col("c.prosecdef"))) | (system & F.col("_safe"))
        severity = (
            F.when(harmless, 0)
            .when(F.col("c.prosecdef"), 4)
            .when(F.col("c.provolatile") == "i", 0)
            .when(F.col("c.provolatile") == "s", 1)
            .when(F.col("c.provolatile") == "v", 3)
            .otherwise(2)
        )
        joined = names.join(
            catalog.alias("c"),
            (F.col("_bare") == F.col("c.name")) & (F.col("_q").isNull() | (F.col("_q") == F.col("c.schema"))),
            "left",
        ).withColumns({"_one": F.when(F.col("c.name").isNotNull(), severity), "_unsafe": ~harmless, "_vis": yes(F.col("c.visible"))})
        narrow = F.col("_vis") & F.col("_q").isNull()

        def both(agg, value):
            return agg(F.when(narrow, value)), agg(value)

        sees, (sv, sa), (uv, ua), (nv, na) = (
            F.max(narrow), both(F.max, F.col("_one")), both(F.max, F.col("_unsafe")), both(F.min, F.col("c.schema")),
        )
        graded = joined.groupBy("_name", "_q", "_bare", "_kinds", "_denied", "_safe", "_danger").agg(
            sees.alias("_sees"), sv.alias("_sv"), sa.alias("_sa"), uv.alias("_uv"), ua.alias("_ua"), nv.alias("_nv"), na.alias("_na")
        ).withColumns(
            {
                "_sev": F.when(F.col("_sees"), F.col("_sv")).otherwise(F.col("_sa")),
                "_bad": F.when(F.col("_sees"), F.col("_uv")).otherwise(F.col("_ua")),
                "_found": F.coalesce("_q", F.when(F.col("_sees"), F.col("_nv")).otherwise(F.col("_na"))),
            }
        )
    known = F.col("_sev").isNotNull()
    builtin = yes(F.col("_q").isNull() | F.col("_q").isin("pg_catalog", "information_schema"))
    assumed = ~known & builtin & (~F.col("_danger") | F.col("_safe"))
    empty = F.array().cast("array<string>")
    effect = F.when(assumed, "immutable").when(~known, "unknown")
    for text, rank in C.EFFECT_SEVERITY.items():
        effect = effect.when(F.col("_sev") == rank, text)
    unknown = F.array(F.lit("unknown_effect"))
    verdicts = graded.select(
        "_name",
        F.when(known, F.concat_ws(".", "_found", "_bare"))
        .when(assumed, F.concat_ws(".", F.coalesce("_q", F.lit("pg_catalog")), "_bare"))
        .when(F.col("_q").isNotNull(), F.col("_name"))
        .alias("qualified_name"),
        effect.alias("effect"),
        F.when(assumed, empty)
        .when(~known, F.concat("_kinds", unknown))
        .otherwise(
            F.concat(
                F.when(F.col("_sev") > 0, unknown).otherwise(empty), F.when(yes(F.col("_bad")), F.col("_kinds")).otherwise(empty)
            )
        )
        .alias("side_effects"),
        (known | assumed).alias("resolved"),
    )
    # one row a distinct name: written out, its size is known and decides whether the references are shuffled
    verdicts = cut_lineage(verdicts, "effects")
    return refs.join(verdicts, F.lower(refs[name]) == verdicts["_name"], "left").drop("_name")


def qualified_of(column: str) -> Column:
    """True for exactly ``schema.name``; more dots cannot be told apart and stay one name."""
    return F.col(column).rlike(r"^[^.]+\.[^.]+$")


# --- resolving and scoping ---------------------------------------------------------------------


def resolve_entry(
    requests: DataFrame,
    registry: DataFrame,
    default_level: str = "read_only",
    alias: str = "asserted_alias",
    project: str = "asserted_project",
) -> DataFrame:
    """Add ``resolved_alias, resolved_database, effective_level, code``.

    An explicit alias first, then the project text as an alias, then as a project name. Only when
    the alias is omitted or ``default`` does the default (or the first, by ``ord``) entry apply.
    """
    entry = F.struct("db_alias", "database", "permission_override")
    by_alias = registry.groupBy(F.col("db_alias").alias("_key")).agg(F.min_by(entry, "ord").alias("_entry"))
    by_project = registry.where("project_name IS NOT NULL").groupBy(F.col("project_name").alias("_key")).agg(
        F.min_by(entry, "ord").alias("_entry")
    )
    first = registry.agg(F.min_by(entry, F.struct(F.col("db_alias") != "default", "ord")).alias("_entry")).scalar()
    explicit = F.when(F.col(alias) != "default", F.when(F.col(alias) != "", F.col(alias)))
    named = F.when(F.col(project) != "default", F.when(F.col(project) != "", F.col(project)))
    df = requests.withColumns({"_a": explicit, "_p": named})
    for i, (key, table) in enumerate((("_a", by_alias), ("_p", by_alias), ("_p", by_project))):
        side = table.select(F.col("_key").alias(f"_k{i}"), F.col("_entry").alias(f"_e{i}"))
        df = df.join(side, F.col(key) == F.col(f"_k{i}"), "left")
    found = F.coalesce("_e0", "_e1", "_e2", F.when(F.col("_a").isNull(), first))
    return df.withColumn("_found", found).select(
        *requests.columns,
        F.col("_found.db_alias").alias("resolved_alias"),
        F.col("_found.database").alias("resolved_database"),
        F.when(F.col("_found").isNotNull(), F.coalesce("_found.permission_override", F.lit(default_level))).alias("effective_level"),
        F.when(F.col("_found").isNull(), "database_not_found").otherwise("ok").alias("code"),
    )


def scope_filter(entries: DataFrame, rules: DataFrame, project: str = "project_name", alias: str = "db_alias") -> DataFrame:
    """Entries some rule permits. A rule's null field matches anything; no rules permit everything.

    Rules are split by which fields they set, so every step is an equi-join whatever their number.
    """
    p, a = F.col("project_name"), F.col("db_alias")
    shape = rules.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max(p.isNull() & a.isNull()), F.lit(False)).alias("open")
    ).select(((F.col("n") == 0) | F.col("open")).alias("all"))
    pairs = rules.where(p.isNotNull() & a.isNotNull()).select(p.alias("_p"), a.alias("_a")).distinct().withColumn("_in1", F.lit(True))
    projects = rules.where(p.isNotNull() & a.isNull()).select(p.alias("_p2")).distinct().withColumn("_in2", F.lit(True))
    aliases = rules.where(p.isNull() & a.isNotNull()).select(a.alias("_a3")).distinct().withColumn("_in3", F.lit(True))
    return (
        entries.join(pairs, (F.col(project) == F.col("_p")) & (F.col(alias) == F.col("_a")), "left")
        .join(projects, F.col(project) == F.col("_p2"), "left")
        .join(aliases, F.col(alias) == F.col("_a3"), "left")
        .withColumn("_all", shape.scalar())
        .where(F.col("_all") | F.coalesce("_in1", "_in2", "_in3", F.lit(False)))
        .select(*entries.columns)
    )


#: parts of the product of projects and aliases
PRODUCT_PARTS = 16


def intersect_rules(a: DataFrame, b: DataFrame) -> DataFrame:
    """What both rule lists permit, as rules: every compatible pair merged to the narrower value
    of each field.

    Rules are split by the fields they set. A rule that sets all fields of the other is the merged one, so these pairs
    are semi-joins on the fields that both set. Only a rule for projects and a rule for aliases make a new one;
    those are all their pairs by definition, dealt out by a hash of the project.
    """
    fields = ["project_name", "db_alias"]

    def shape(rules: DataFrame, *set_: str) -> DataFrame:
        return rules.where(" and ".join(f"{f} is {'not ' if f in set_ else ''}null" for f in fields)).select(*fields)

    a, b = a.select(*fields).distinct(), b.select(*fields).distinct()
    found = shape(a, *fields).join(shape(b, *fields), fields, "left_semi")
    for one, other in ((a, b), (b, a)):
        # a rule that sets nothing permits all that the other list does
        open_ = other.agg(F.coalesce(F.max(F.col("project_name").isNull() & F.col("db_alias").isNull()), F.lit(False)).alias("open"))
        found = found.unionByName(one.where(open_.scalar()))
        for f in fields:
            found = found.unionByName(shape(one, *fields).join(shape(other, f).select(f), f, "left_semi").select(*fields))
        projects = shape(one, "project_name").select("project_name", F.pmod(F.xxhash64("project_name"), F.lit(PRODUCT_PARTS)).alias("_part"))
        parts = F.sequence(F.lit(0).cast("bigint"), F.lit(PRODUCT_PARTS - 1).cast("bigint"))
        aliases = shape(other, "db_alias").select("db_alias", F.explode(parts).alias("_part"))
        found = found.unionByName(projects.join(aliases, "_part").select(*fields))
    for f in fields:
        found = found.unionByName(shape(a, f).join(shape(b, f).select(f), f, "left_semi").select(*fields))
    return found.where("project_name IS NOT NULL OR db_alias IS NOT NULL").distinct()


# --- the decision ------------------------------------------------------------------------------

_NO_EFFECT = ", ".join(lit(e) for e in C.NON_TRANSACTIONAL_EFFECTS)


def is_provable_read() -> Column:
    """One read statement with no violation, no lasting side effect and only immutable functions."""
    return F.expr(
        "coalesce(type = 'read' AND parse_ok AND statement_count = 1 AND size(read_violations) = 0 "
        f"AND NOT exists(coalesce(side_effects, array()), e -> e IN ({_NO_EFFECT})) "
        f"AND NOT exists(function_effects, f -> exists(f.side_effects, e -> e IN ({_NO_EFFECT}))) "
        "AND forall(function_effects, f -> f.effect = 'immutable' AND f.resolved), false)"
    )


def class_capability() -> Column:
    """Capability the statement class needs; anything that escapes or is unknown needs ``ddl``."""
    escaped = F.expr(f"exists(read_violations, v -> v IN ({', '.join(lit(v) for v in C.READ_ESCAPES)}))")
    return (
        F.when(escaped, "ddl")
        .when(F.col("type") == "read", F.when(is_provable_read(), "query_read").otherwise("ddl"))
        .when(F.col("type") == "write", "query_write")
        .otherwise("ddl")
    )


def _text_map(texts: Mapping[str, str]) -> str:
    return "map(" + ", ".join(f"{lit(k)}, {lit(v)}" for k, v in texts.items()) + ")"


def _listed(names: str, cap: int = 3) -> str:
    """``a(), b(), c() and 2 more``"""
    unique = f"transform(array_distinct({names}), n -> concat(n, '()'))"
    return (
        f"CASE WHEN size({unique}) <= {cap} THEN array_join({unique}, ', ') "
        f"ELSE concat(array_join(slice({unique}, 1, {cap}), ', '), ' and ', size({unique}) - {cap}, ' more') END"
    )


def explain_not_a_read() -> Column:
    """Why a statement is not a provable read: concrete effects first, then structural escapes,
    then the functions without a verdict, then those with an unsafe one."""
    kinds = "concat(coalesce(side_effects, array()), flatten(transform(coalesce(function_effects, array()), f -> f.side_effects)))"
    effects = f"array_distinct(filter(transform({kinds}, k -> try_element_at({_text_map(C.EFFECT_TEXT)}, k)), t -> t IS NOT NULL))"
    kept = f"filter(read_violations, v -> v <> 'denied_function' OR size({effects}) = 0)"
    escapes = (
        f"array_distinct(filter(transform({kept}, v -> try_element_at({_text_map(C.STRUCTURAL_ESCAPE_TEXT)}, v)), t -> t IS NOT NULL))"
    )
    unresolved = "transform(filter(coalesce(function_effects, array()), f -> NOT f.resolved), f -> f.name)"
    unproven = "filter(coalesce(function_effects, array()), f -> f.resolved AND f.effect <> 'immutable')"
    phrase = (
        f"concat('it calls ', {_listed(f'transform(filter({unproven}, f -> f.effect = x), f -> f.name)')}, "
        f"', which pg_proc reports as ', try_element_at({_text_map(C.VERDICT_TEXT)}, x))"
    )
    verdicts = f"array_join(transform(array_distinct(transform({unproven}, f -> f.effect)), x -> {phrase}), '; and ')"
    nothing = "'it is not provably free of side effects'"
    return F.expr(
        f"CASE WHEN size(read_violations) > 0 THEN CASE "
        f"WHEN size({effects}) + size({escapes}) > 0 THEN array_join(concat({effects}, {escapes}), '; and ') "
        f"WHEN size({unresolved}) > 0 THEN concat('pg_proc has no verdict for ', {_listed(unresolved)}, ', so the call cannot be proved harmless') "
        f"WHEN size({unproven}) > 0 THEN {verdicts} ELSE {nothing} END "
        f"WHEN type <> 'read' THEN concat('it is a ''', type, ''' statement (', coalesce(nullif(verb, ''), type), '), not a read') "
        f"WHEN size({effects}) > 0 THEN array_join({effects}, '; and ') "
        f"WHEN size({unproven}) > 0 THEN {verdicts} "
        f"WHEN size(coalesce(function_effects, array())) > 0 THEN 'it calls a function pg_proc does not prove IMMUTABLE' ELSE {nothing} END"
    )


def decide(requests: DataFrame, role_caps: DataFrame | None = None) -> DataFrame:
    """Add ``allowed, code, reason``: the first failing gate decides.

    Columns: ``role, permission_level, intent, message_type``, the classification
    (``type, verb, parse_ok, statement_count, read_violations, side_effects, function_effects``)
    and the outside answers ``plan_granted`` and ``approved``; an absent one is a refusal. A plan's
    entries are checked one by one through ``empty_parts`` and ``multi_parts`` when present.
    """
    df = requests
    for name, fallback in (
        ("empty_parts", F.when(F.col("statement_count") == 0, 1).otherwise(0)),
        ("multi_parts", F.when(F.col("statement_count") > 1, 1).otherwise(0)),
        ("plan_granted", F.lit(False)),
        ("approved", F.lit(False)),
    ):
        if name not in df.columns:
            df = df.withColumn(name, fallback)
    role = F.col("role")
    needs_message = _mapped(F.col("message_type"), C.MESSAGE_CAPABILITY)
    df = df.withColumns({"_provable": is_provable_read(), "_class_cap": class_capability(), "_message_cap": needs_message})
    if role_caps is None:
        can_message = has_capability(role, F.col("_message_cap"))
        can_class = has_capability(role, F.col("_class_cap"))
    else:
        # one row per role: a role's capabilities are a closed vocabulary
        sets = role_caps.groupBy(F.col("role").alias("_role")).agg(F.collect_set("capability").alias("_caps"))
        df = df.join(sets, F.col("role") == F.col("_role"), "left")
        can_message = yes(F.array_contains("_caps", F.col("_message_cap")))
        can_class = yes(F.array_contains("_caps", F.col("_class_cap")))
    run = F.col("message_type") == "migration_run"
    intent, level = F.col("intent"), F.col("permission_level")
    agrees = (intent == F.col("type")) | ((intent == "read") & (F.col("verb") == "SELECT")) | ((intent == "migration") & run)
    provable = F.col("_provable")
    code = (
        F.when(~yes(F.col("parse_ok")) | (F.col("empty_parts") > 0), "unparseable_statement")
        .when(F.col("multi_parts") > 0, "multiple_statements")
        .when((intent == "migration") & ~run, "intent_not_applicable")
        .when(~yes(agrees), "intent_mismatch")
        .when(F.col("_message_cap").isNotNull() & ~can_message, "role_insufficient")
        .when(~can_class, "role_insufficient")
        .when(level == "full", "allowed")
        .when(level.isin("read_only", "auto_upgrade", "manual") & provable, "allowed")
        .when((level == "auto_upgrade") & yes(F.col("plan_granted")), "auto_upgrade_granted")
        .when(level == "auto_upgrade", "plan_not_registered")
        .when((level == "manual") & yes(F.col("approved")), "allowed")
        .otherwise("permission_denied")
    )
    df = df.withColumns({"code": code, "_refused_message": F.col("_message_cap").isNotNull() & ~can_message})
    reason = (
        F.when(F.col("code").isin("allowed", "auto_upgrade_granted"), F.lit(None).cast("string"))
        .when(F.col("code") == "unparseable_statement", "PostgreSQL could not parse it")
        .when(F.col("code") == "multiple_statements", "it contains more than one statement, and all of them would run")
        .when(F.col("code") == "intent_not_applicable", F.concat(F.lit("Intent 'migration' is not meaningful on '"), "message_type", F.lit("'")))
        .when(
            F.col("code") == "intent_mismatch",
            F.concat(F.lit("Intent mismatch: declared '"), intent, F.lit("' but parsed as '"), "type", F.lit("' ("), "verb", F.lit(")")),
        )
        .when(
            (F.col("code") == "role_insufficient") & F.col("_refused_message"),
            F.concat(F.lit("Role '"), role, F.lit("' cannot perform '"), "_message_cap", F.lit("'")),
        )
        .when(F.col("code") == "role_insufficient", F.concat(F.lit("Role '"), role, F.lit("' cannot run '"), "type", F.lit("' statements")))
        .when(F.col("code") == "plan_not_registered", "Auto-upgrade not granted")
        .when(level == "read_only", F.concat(F.lit("Read-only mode: "), explain_not_a_read()))
        .when(level == "manual", "Approval denied")
        .otherwise(F.concat(F.lit("Invalid permission level '"), level, F.lit("'")))
    )
    return df.select(
        *requests.columns, F.col("code").isin("allowed", "auto_upgrade_granted").alias("allowed"), "code", reason.alias("reason")
    )


def _mapped(column: Column, values: Mapping[str, str]) -> Column:
    expr = F.lit(None).cast("string")
    for key, value in values.items():
        expr = F.when(column == key, F.lit(value)).otherwise(expr)
    return expr


# --- plans, cancels and approvals --------------------------------------------------------------


def authorise_plans(runs: DataFrame, plans: DataFrame) -> DataFrame:
    """Add ``ok, code`` to every run ``(run_id, plan_id, ts_ms, user_id, role, level,
    statements_hash, project, db_alias)`` of a registered plan.

    A plan is single-use: the earliest run that passes every check consumes it. The earliest
    late run removes an unconsumed plan. Both moments are one aggregate per plan, not a window, so
    a plan with very many runs stays parallel.
    """
    prefixed = plans.select(*[F.col(c).alias(f"_{c}") for c in plans.columns])
    df = runs.join(prefixed, F.col("plan_id") == F.col("_plan_id"), "left")
    blank = F.lit("")

    def text(c):
        return F.trim(F.coalesce(c, blank))

    scoped = (
        (text("_project") != blank) & (text("_db_alias") != blank)
        & (text("_project") == text("project")) & (text("_db_alias") == text("db_alias"))
    )
    unattested = F.col("_role").isNull() | F.col("_level").isNull()
    same_user = F.col("_registered_by") == F.col("user_id")
    mine, theirs = role_rank(F.col("role")), role_rank(F.col("_role"))
    outranks = yes(mine >= theirs) & (same_user | yes(mine > theirs))
    permissive = yes(level_rank(F.col("level")) >= level_rank(F.col("_level")))
    checks = (
        F.when(F.col("_plan_id").isNull(), "plan_not_registered")
        .when(F.col("ts_ms") > F.col("_expires_ms"), "plan_expired")
        .when(~F.col("statements_hash").eqNullSafe(F.col("_statements_hash")), "statements_changed")
        .when(~scoped, "plan_scope_mismatch")
        .when(unattested, F.when(~same_user, "principal_not_attested"))
        .when(~permissive, "registered_at_more_permissive_level")
        .when(~outranks, "runner_not_privileged")
    )
    df = df.withColumn("_refusal", checks).select(*runs.columns, "_refusal")
    moment = F.struct("ts_ms", "run_id")
    ends = df.groupBy("plan_id").agg(
        F.min(F.when(F.col("_refusal").isNull(), moment)).alias("_consumed"),
        F.min(F.when(F.col("_refusal") == "plan_expired", moment)).alias("_expired"),
    )
    after_use = F.col("_consumed").isNotNull() & (moment > F.col("_consumed"))
    removed = F.col("_consumed").isNull() & F.col("_expired").isNotNull() & (moment > F.col("_expired"))
    code = F.when(after_use, "plan_already_consumed").when(removed, "plan_not_registered").otherwise(F.col("_refusal"))
    # a run without a plan id meets no end and stays refused
    return df.join(ends, ["plan_id"], "left").withColumn("code", code).select(
        *runs.columns, F.col("code").isNull().alias("ok"), "code"
    )


def authorise_cancels(cancels: DataFrame, requests: DataFrame) -> DataFrame:
    """Add ``code`` (and the owner) to cancels ``(cancel_id, ts_ms, user_id, role, target_id)``.

    The target must be in flight at the cancel's time; its owner, or a strictly higher role, may
    cancel it. ``requests`` has ``request_id, start_ms, end_ms, user_id, role``.
    """
    target = requests.select(*[F.col(c).alias(f"_{c}") for c in ("request_id", "start_ms", "end_ms", "user_id", "role")])
    df = cancels.join(target, F.col("target_id") == F.col("_request_id"), "left")
    running = yes((F.col("_start_ms") <= F.col("ts_ms")) & (F.col("ts_ms") < F.col("_end_ms")))
    outranks = yes(role_rank(F.col("role")) > role_rank(F.col("_role")))
    code = (
        F.when(~has_capability(F.col("role"), F.lit("cancel")), "role_insufficient")
        .when(~running, "cancel_target_not_found")
        .when(~yes(F.col("_user_id") == F.col("user_id")) & ~outranks, "cancel_not_permitted")
        .otherwise("allowed")
    )
    return df.select(*cancels.columns, code.alias("code"), F.when(running, F.col("_user_id")).alias("target_user_id"))


def approval_window(ms: int = C.APPROVAL_MS) -> int:
    return min(max(ms, C.APPROVAL_MIN_MS), C.APPROVAL_MAX_MS)


def match_approvals(requests: DataFrame, responses: DataFrame, window_ms: int = C.APPROVAL_MS) -> DataFrame:
    """Add ``decision, decided_ms`` to requests ``(request_id, user_id, ts_ms, nonce)``.

    A response counts when it comes from the requesting user with the right nonce and the
    approving capability inside the window; the first such response decides, none is ``expired``.
    """
    answers = responses.where(has_capability(F.col("role"), F.lit("approve_ddl"))).select(
        F.col("request_id").alias("_request_id"), F.col("user_id").alias("_user_id"), F.col("nonce").alias("_nonce"),
        F.col("ts_ms").alias("_ts_ms"), F.col("approved").alias("_approved"),
    )
    timely = (F.col("_ts_ms") >= F.col("ts_ms")) & (F.col("_ts_ms") <= F.col("ts_ms") + approval_window(window_ms))
    # An inner join can be split on either side, so very many responses to one request stay
    # parallel; what joins back is one row per decided request.
    decided = (
        requests.join(
            answers,
            (F.col("request_id") == F.col("_request_id")) & (F.col("user_id") == F.col("_user_id"))
            & (F.col("nonce") == F.col("_nonce")) & timely,
        )
        .groupBy(F.col("request_id").alias("_id"))
        .agg(F.min(F.struct("_ts_ms", (~F.col("_approved")).alias("_no"))).alias("_first"))
    )
    answered = requests.join(decided, F.col("request_id") == F.col("_id"), "left")
    return answered.select(
        *requests.columns,
        F.when(F.col("_first").isNull(), "expired").when(F.col("_first._no"), "rejected").otherwise("approved").alias("decision"),
        F.col("_first._ts_ms").alias("decided_ms"),
    )


# --- roles and findings ------------------------------------------------------------------------


def negotiated_roles(requested: str, ceiling: str | Column = "developer", to: str = "accepted") -> Column:
    """Requested roles that are real and not above the ceiling, in canonical order; an absent or
    wholly invalid request accepts nothing."""
    canonical = F.array(*[F.lit(r) for r in C.ROLES])
    limit = role_rank(F.lit(ceiling) if isinstance(ceiling, str) else ceiling)
    within = F.filter(canonical, lambda r: role_rank(r) <= limit)
    return F.array_intersect(within, F.coalesce(requested, F.array().cast("array<string>"))).alias(to)


def first_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each case-blind key. An aggregate rather than a window: only one row per
    key and task is shuffled."""
    kept = F.min_by(F.struct(*df.columns), order).alias("_row")
    return df.groupBy(F.lower(key).alias("_key")).agg(kept).select("_row.*")


def policy_findings(
    facts: DataFrame,
    attributes: Mapping[str, bool] = C.REQUIRED_ATTRIBUTES,
    must_be_false: Mapping[str, str] | None = None,
    memberships: str = "memberships",
    forbidden: Sequence[str] = C.FORBIDDEN_MEMBERSHIPS,
    read_only: str = "default_transaction_read_only",
) -> DataFrame:
    """Add ``findings``, every departure of a login role from the policy, in policy order. An
    unanswered probe is itself a finding. Row-wise: no join and no shuffle."""
    must_be_false = must_be_false or {"can_create_temp": "TEMP on database", "can_create_in_public": "CREATE on schema public"}
    found = []
    for name, expected in attributes.items():
        wanted = str(expected).lower()
        found.append(
            F.when(F.col(name).isNull(), f"{name} could not be read").when(
                F.col(name) != F.lit(expected), F.concat(F.lit(f"{name}="), F.col(name).cast("string"), F.lit(f" (expected {wanted})"))
            )
        )
    for name, label in must_be_false.items():
        found.append(F.when(F.col(name).isNull(), f"{label} could not be read").when(F.col(name), f"{label} is granted"))
    held = F.array_intersect(F.col(memberships), F.array(*[F.lit(m) for m in forbidden]))
    found.append(F.when(F.size(held) > 0, F.concat(F.lit("member of "), F.array_join(held, ", "))))
    found.append(
        F.when(F.col(read_only).isNull(), f"{read_only} could not be read").when(
            F.col(read_only) != "on", F.concat(F.lit(f"{read_only}="), F.col(read_only), F.lit(" (expected on)"))
        )
    )
    return facts.withColumn("findings", F.filter(F.array(*found), lambda f: f.isNotNull()))

"""Ordered text rules compiled to one first-match expression.

A rule table is data: (result fields ..., pattern). The compiler builds a
`coalesce(when(rlike), ...)` chain per pass, so that the whole classification
is one projection of built-in functions and its first matching rule wins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Agent aliases, the most specific first.
AGENT_ALIASES = (
    ("cursor agent", "Cursor Agent"),
    ("cursor ai", "Cursor Agent"),
    ("cursor", "Cursor Agent"),
    ("claude code", "Claude Code"),
    ("claude cli", "Claude Code"),
    ("openai codex", "Codex"),
    ("codex", "Codex"),
    ("copilot coding agent", "GitHub Copilot Coding Agent"),
    ("github copilot", "GitHub Copilot Coding Agent"),
    ("copilot", "GitHub Copilot Coding Agent"),
    ("cline agent", "Cline"),
    ("cline", "Cline"),
    ("windsurf cascade", "Windsurf Cascade"),
    ("windsurf ai", "Windsurf Cascade"),
    ("windsurf", "Windsurf Cascade"),
    ("cascade", "Windsurf Cascade"),
    ("devin ai", "Devin"),
    ("devin", "Devin"),
    ("opencode ai", "OpenCode"),
    ("opencode", "OpenCode"),
    ("antigravity ai", "Google Antigravity"),
    ("antigravity", "Google Antigravity"),
    ("google jules", "Google Jules"),
)
OTHER_AGENT = "Otro Agente IA"

# Platform rules (name, type, ecosystem, pattern) in order.
PLATFORM_RULES = (
    ("VS Code", "Entorno de desarrollo", "Ecosistema Microsoft", r"vs[ -]?code|visual studio code"),
    ("JetBrains IDEs", "Entorno de desarrollo", "Ecosistema JetBrains", r"\bjetbrains\b|\bintellij\b|\bpycharm\b"),
    ("Terminal / CLI", "Interfaz de línea de comandos", "Desarrollo local", r"command[ -]?line|\bcli\b|\bterminal\b"),
    ("GitHub", "Plataforma DevOps", "Ecosistema GitHub", r"github actions|github app|pull request"),
    ("Amazon Web Services", "Plataforma cloud", "Cloud", r"amazon web services|aws (?:lambda|bedrock|cloud|codebuild|sagemaker)"),
    ("Microsoft Azure", "Plataforma cloud", "Cloud", r"microsoft azure|\bazure\b"),
    ("Google Cloud", "Plataforma cloud", "Cloud", r"google cloud|\bgcp\b"),
    ("API / SDK", "Interfaz programática", "Integración de software", r"\bapi\b|\bsdk\b"),
    ("Web", "Aplicación web", "Navegador", r"web[ -]?app|web[ -]?based|browser extension|interfaz web"),
    ("Extensión de IDE", "Integración de editor", "Herramientas de desarrollo", r"ide extension|editor extension|ide plugin|editor plugin"),
)

# Platforms that an agent's own name implies.
AGENT_PLATFORMS = {
    "cursor": ("IDE dedicado", "Entorno de desarrollo", "Desarrollo local"),
    "windsurf": ("IDE dedicado", "Entorno de desarrollo", "Desarrollo local"),
    "aws kiro": ("IDE dedicado", "Entorno de desarrollo", "Ecosistema AWS"),
    "claude code": ("Terminal / CLI", "Interfaz de línea de comandos", "Desarrollo local"),
    "aider": ("Terminal / CLI", "Interfaz de línea de comandos", "Desarrollo local"),
    "gemini cli": ("Terminal / CLI", "Interfaz de línea de comandos", "Desarrollo local"),
    "jetbrains junie": ("JetBrains IDEs", "Entorno de desarrollo", "Ecosistema JetBrains"),
    "cline": ("VS Code", "Entorno de desarrollo", "Ecosistema Microsoft"),
    "roo code": ("VS Code", "Entorno de desarrollo", "Ecosistema Microsoft"),
}

# Community of a source.
SOURCE_COMMUNITIES = {
    "devto": ("DEV Community", "comunidad técnica"),
    "hackernews": ("Hacker News", "foro técnico"),
    "google_trends": ("Audiencia de Google Search", "audiencia de búsqueda"),
    "stackoverflow": ("Stack Overflow", "Q&A técnica"),
    "arxiv": ("arXiv", "repositorio académico"),
    "gnews": ("Google News", "agregador editorial"),
}

# Signal type of a source.
SOURCE_SIGNALS = {
    "github": "Actividad de repositorio",
    "catalogo": "Actividad de desarrollo",
    "devto": "Publicación técnica",
    "hackernews": "Discusión técnica",
    "google_trends": "Interés de búsqueda",
    "reddit": "Discusión comunitaria",
    "stackoverflow": "Pregunta o respuesta técnica",
    "arxiv": "Publicación científica",
    "gnews": "Cobertura mediática",
}

# Technology rules (name, category, domain, pattern) in order.
TECHNOLOGY_RULES = (
    ("TypeScript", "Lenguaje de programación", "Desarrollo de software", r"\btypescript\b"),
    ("JavaScript", "Lenguaje de programación", "Desarrollo de software", r"\bjavascript\b|\bjs\b"),
    ("Python", "Lenguaje de programación", "Desarrollo de software", r"\bpython\b"),
    ("C# / .NET", "Plataforma de desarrollo", "Desarrollo de software", r"c#|\bcsharp\b|\.net\b|\bdotnet\b"),
    ("C++", "Lenguaje de programación", "Desarrollo de software", r"c\+\+|\bcpp\b"),
    ("Java", "Lenguaje de programación", "Desarrollo de software", r"\bjava\b"),
    ("Rust", "Lenguaje de programación", "Desarrollo de software", r"\brust\b"),
    ("Golang", "Lenguaje de programación", "Desarrollo de software", r"\bgolang\b"),
    ("PHP", "Lenguaje de programación", "Desarrollo de software", r"\bphp\b"),
    ("Ruby", "Lenguaje de programación", "Desarrollo de software", r"\bruby\b"),
    ("Kotlin", "Lenguaje de programación", "Desarrollo de software", r"\bkotlin\b"),
    ("Swift", "Lenguaje de programación", "Desarrollo de software", r"\bswift\b"),
    ("Scala", "Lenguaje de programación", "Desarrollo de software", r"\bscala\b"),
    ("Dart", "Lenguaje de programación", "Desarrollo de software", r"\bdart\b"),
    ("Shell", "Lenguaje de programación", "Desarrollo de software", r"\bshell\b|\bbash\b|\bpowershell\b"),
    ("R", "Lenguaje de programación", "Ciencia de datos", r"(?:^|[,;|\s])r(?:$|[,;|\s])"),
    ("SQL", "Lenguaje de consulta", "Datos y analítica", r"\bsql\b|postgresql|sql server|mysql"),
    ("React", "Framework o librería", "Aplicaciones web", r"\breact(?:js)?\b"),
    ("Angular", "Framework o librería", "Aplicaciones web", r"\bangular\b"),
    ("Vue.js", "Framework o librería", "Aplicaciones web", r"\bvue(?:\.js|js)?\b"),
    ("Spring Boot", "Framework o librería", "Aplicaciones backend", r"\bspring[ -]?boot\b"),
    ("Node.js", "Runtime", "Aplicaciones backend", r"\bnode(?:\.js|js)\b"),
    ("Docker", "Infraestructura", "DevOps y plataforma", r"\bdocker\b|containerization"),
    ("Kubernetes", "Infraestructura", "DevOps y plataforma", r"\bkubernetes\b|\bk8s\b"),
    ("Microsoft Azure", "Plataforma cloud", "Cloud", r"\bazure\b"),
    ("Amazon Web Services", "Plataforma cloud", "Cloud", r"\baws\b|amazon web services"),
    ("Google Cloud", "Plataforma cloud", "Cloud", r"google cloud|\bgcp\b"),
    ("VS Code", "Entorno de desarrollo", "Herramientas de desarrollo", r"vs[ -]?code|visual studio code"),
    ("JetBrains IDEs", "Entorno de desarrollo", "Herramientas de desarrollo", r"\bjetbrains\b|intellij|pycharm"),
    ("Model Context Protocol", "Protocolo de IA", "IA generativa y agentes", r"model context protocol|\bmcp\b"),
    ("RAG", "Arquitectura de IA", "IA generativa y agentes", r"retrieval[ -]augmented|\brag\b"),
    ("Modelos de lenguaje", "Tecnología de IA", "IA generativa y agentes", r"large language model|\bllms?\b"),
    ("API / SDK", "Interfaz de integración", "Integración de software", r"\bapi\b|\bsdk\b"),
    ("CLI", "Interfaz de integración", "Herramientas de desarrollo", r"command[ -]line|\bcli\b"),
    ("Testing", "Capacidad de ingeniería", "Ingeniería de software asistida", r"\btesting\b|\btests?\b"),
    ("Depuración", "Capacidad de ingeniería", "Ingeniería de software asistida", r"debugging|depuración"),
    ("Revisión de código", "Capacidad de ingeniería", "Ingeniería de software asistida", r"code review|revisión de código"),
    ("Inteligencia artificial", "Área de investigación", "IA y aprendizaje automático", r"artificial-intelligence|\bcs\.ai\b"),
    ("Aprendizaje automático", "Área de investigación", "IA y aprendizaje automático", r"machinelearning|machine learning|\bcs\.lg\b"),
    ("Procesamiento de lenguaje natural", "Área de investigación", "IA y aprendizaje automático", r"natural language processing|\bcs\.cl\b"),
    ("Ingeniería de software", "Área de investigación", "Desarrollo de software", r"software engineering|\bcs\.se\b"),
)


def literals(pattern: str) -> list[str]:
    """For each alternative of a pattern the longest text that every match of it holds, lower-cased; none if one has no such text.

    Groups, classes and what may be absent count for nothing.
    """
    alternatives, depth, quoted, current = [], 0, False, [""]
    for i, c in enumerate(pattern):
        if quoted:
            quoted = False
            if c.isalnum():  # a class or an anchor
                current.append("")
            elif not depth:
                current[-1] += c
        elif c == "\\":
            quoted = True
        elif c in "([{":
            if c == "{":
                current[-1] = current[-1][:-1]
            depth += 1
            current.append("")
        elif c in ")]}":
            depth -= 1
            current.append("")
        elif depth:
            continue
        elif c == "|":
            alternatives.append(current)
            current = [""]
        elif c in "?*":
            current[-1] = current[-1][:-1]
            current.append("")
        elif c in ".^$+":
            current.append("")
        else:
            current[-1] += c
    found = [max(runs, key=len).lower() for runs in (*alternatives, current)]
    return [] if "" in found else found


def folded(text: Column) -> Column:
    """Text in which a literal occurs wherever a pattern without regard to case finds it."""
    return F.lower(F.upper(F.translate(text, "İ", "i")))


def may_match(hay: Column, pattern: str) -> Column:
    """Whether folded text holds what every match of the pattern must hold: a search of bytes in place of most patterns' scans."""
    needed = literals(pattern)
    return reduce(Column.__or__, [F.contains(hay, F.lit(n)) for n in needed]) if needed else F.lit(True)


def first_match(text: Column, rules: Sequence[tuple], names: Sequence[str], method: str | None = None) -> Column:
    """Struct of the first rule whose pattern (its last field) occurs in the text, else null; case does not matter."""
    found = []
    for *values, pattern in rules:
        fields = [F.lit(v).alias(n) for n, v in zip(names, values)]
        if method is not None:
            fields.append(F.lit(method).alias("method"))
        found.append(F.when(text.rlike("(?iuU)" + pattern), F.struct(*fields)))
    return F.coalesce(*found)


def first_number(text: Column, rules: Sequence[tuple]) -> Column:
    """Number of the first rule that matches, else null.

    The text is folded once and bound to a variable: as a lambda the chain is
    no part of the stage's generated method, which a chain of many patterns
    makes too long for the machine to compile.
    """

    def tried(t: Column) -> Column:
        return F.coalesce(*[F.when(may_match(t["hay"], r[-1]) & t["text"].rlike("(?iuU)" + r[-1]), F.lit(i)) for i, r in enumerate(rules)])

    bound = F.when(text != "", F.array(F.struct(text.alias("text"), folded(text).alias("hay"))))
    return F.transform(bound, tried)[0]


def rule_values(number: Column, rules: Sequence[tuple], names: Sequence[str]) -> list[Column]:
    """The named fields of the rule with that number."""
    return [F.get(F.array(*[F.lit(r[i]) for r in rules]), number).alias(n) for i, n in enumerate(names)]


def lookup(key: Column, table: Mapping[str, tuple | str], names: Sequence[str], method: str | None = None) -> Column:
    """Struct of the table row whose key equals `key`, else null."""
    found = []
    for k, values in table.items():
        values = values if isinstance(values, tuple) else (values,)
        fields = [F.lit(v).alias(n) for n, v in zip(names, values)]
        if method is not None:
            fields.append(F.lit(method).alias("method"))
        found.append(F.when(key == k, F.struct(*fields)))
    return F.coalesce(*found)


def clean_text(column: Column) -> Column:
    """Text without outer white space; null and written-out nulls are empty."""
    text = F.btrim(F.coalesce(column.cast("string"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(text.isin("nan", "None", "<NA>"), F.lit("")).otherwise(text)


def detect_agent(direct: Column, title: Column, text: Column, aliases: Sequence[tuple[str, str]] = AGENT_ALIASES) -> Column:
    """Official agent name: from the direct field first, then from title and text; the first alias in the list wins."""
    named = F.lower(F.replace(F.coalesce(direct, F.lit("")), F.lit("_"), F.lit(" ")))
    context = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(text, F.lit(""))))
    context = F.replace(context, F.lit("_"), F.lit(" "))

    def chain(value: Column) -> Column:
        return F.coalesce(*[F.when(F.contains(value, F.lit(alias)) & value.rlike(rf"(?U)\b{alias}\b"), F.lit(name)) for alias, name in aliases])

    return F.coalesce(chain(named), chain(context), F.lit(OTHER_AGENT))


def category(source: Column, stars: Column) -> Column:
    return (
        F.when((source == "github") & (F.coalesce(stars, F.lit(0)) > 1000), "popularidad")
        .when(source == "github", "produccion_tecnica")
        .when(source == "hackernews", "comunidad")
        .when(source == "google_trends", "popularidad")
        .otherwise("actividad_tecnica")
    )


def _col(df: DataFrame, name: str) -> Column:
    return clean_text(F.col(name)) if name in df.columns else F.lit("")


def enrich(df: DataFrame) -> DataFrame:
    """Platform, technology, signal type and community of observations, each with the method that found it."""
    names = ("fuente", "tecnologia_raw", "llm_entorno_uso", "llm_tipo_integracion", "titulo", "texto", "llm_capacidades", "nombre_agente", "comunidad_raw", "tipo_comunidad_raw", "region_comunidad_raw")
    clean = {n: f"clean_{n}_" for n in names}
    df = df.withColumns({c: _col(df, n) for n, c in clean.items()} | {"source_": F.lower(_col(df, "fuente")), "agent_": F.lower(_col(df, "nombre_agente"))})
    c = {n: F.col(v) for n, v in clean.items()}  # cleaned once; what follows looks at them many times
    structured = F.concat_ws(" | ", c["tecnologia_raw"], c["llm_entorno_uso"], c["llm_tipo_integracion"])
    context = F.concat_ws(" | ", structured, c["titulo"], c["texto"], c["llm_capacidades"])
    tech_context = F.concat_ws(" | ", c["tecnologia_raw"], c["titulo"], c["texto"], c["llm_capacidades"])
    place, tool = ("name", "kind", "ecosystem"), ("name", "category", "domain")

    def fixed(names: Sequence[str], *values: str) -> Column:
        return F.struct(*[F.lit(v).alias(n) for n, v in zip((*names, "method"), (*values, "sin_evidencia"))])

    rows = df.withColumns({"place_1_": first_number(structured, PLATFORM_RULES), "tool_1_": first_number(c["tecnologia_raw"], TECHNOLOGY_RULES)})
    once = lambda first, second: F.when(F.col(first).isNull(), second)
    rows = rows.withColumns({"place_2_": once("place_1_", first_number(context, PLATFORM_RULES)), "tool_2_": once("tool_1_", first_number(tech_context, TECHNOLOGY_RULES))})

    def found(first: str, second: str, rules: Sequence[tuple], names: Sequence[str]) -> Column:
        method = F.when(F.col(first).isNotNull(), "metadata_estructurada").otherwise("regla_contextual").alias("method")
        number = F.coalesce(first, second)
        return F.when(number.isNotNull(), F.struct(*rule_values(number, rules, names), method))

    nothing = {"platform_": ("No determinada", "No determinado", "No determinado"), "technology_": ("No determinada", "No determinada", "No determinado")}
    rows = rows.withColumns(
        {
            "platform_": F.coalesce(found("place_1_", "place_2_", PLATFORM_RULES, place), lookup(F.col("agent_"), AGENT_PLATFORMS, place, "regla_agente"), fixed(place, *nothing["platform_"])),
            "technology_": F.coalesce(found("tool_1_", "tool_2_", TECHNOLOGY_RULES, tool), fixed(tool, *nothing["technology_"])),
        }
    )
    source = F.col("source_")
    rows = rows.withColumns({"community_": lookup(source, SOURCE_COMMUNITIES, ("name", "kind")), "signal_": lookup(source, SOURCE_SIGNALS, ("name",))})
    community = F.col("community_")
    given = lambda n: F.nullif(c[n], F.lit(""))
    return rows.withColumns(
        {
            "dim_nombre_plataforma": F.col("platform_.name"),
            "dim_tipo_plataforma": F.col("platform_.kind"),
            "dim_ecosistema": F.col("platform_.ecosystem"),
            "dim_plataforma_metodo": F.col("platform_.method"),
            "plataforma": F.col("platform_.name"),
            "dim_nombre_tecnologia": F.col("technology_.name"),
            "dim_categoria_tecnologia": F.col("technology_.category"),
            "dim_dominio_tecnologico": F.col("technology_.domain"),
            "dim_tecnologia_metodo": F.col("technology_.method"),
            "dim_tipo_senal": F.coalesce(F.col("signal_.name"), F.lit("Observación digital")),
            "dim_nombre_comunidad": F.coalesce(given("comunidad_raw"), community["name"], F.lit("Comunidad no determinada")),
            "dim_tipo_comunidad": F.coalesce(given("tipo_comunidad_raw"), community["kind"], F.lit("comunidad no determinada")),
            "dim_region_comunidad": F.coalesce(given("region_comunidad_raw"), F.lit("Global")),
            "dim_comunidad_metodo": F.when(c["comunidad_raw"] != "", "metadata_estructurada").otherwise("regla_fuente"),
        }
    ).drop(*clean.values(), "source_", "agent_", "community_", "signal_", "platform_", "technology_", "place_1_", "place_2_", "tool_1_", "tool_2_")


def method_shares(df: DataFrame, method: str) -> DataFrame:
    """Rows and percentage by resolution method."""
    from veleta.operators.measures import share

    return df.groupBy(F.col(method).alias("method")).agg(F.count(F.lit(1)).alias("n")).withColumn("pct", share("n"))


def coverage(df: DataFrame, columns: Mapping[str, str], missing: Mapping[str, str]) -> DataFrame:
    """One row: percentage of rows resolved for each named column."""
    pct = lambda c, m: F.round(F.avg(F.when(F.col(c) != m, 1.0).otherwise(0.0)) * 100, 2)
    return df.agg(*[pct(c, missing[n]).alias(n) for n, c in columns.items()])

"""The data contract: columns, keys and dimensions as data, so operators are not tied to one schema."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The names of the source files' columns, and their order in a year.
MONTHS = (
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
)
INSTITUTION = ("nivel_gobierno", "sector", "pliego", "sec_ejec", "ejecutora")
EXECUTOR_PLACE = ("departamento_ejecutora", "provincia_ejecutora", "distrito_ejecutora")
PROGRAMME = ("programa_ppto", "tipo_act_proy", "producto_proyecto", "actividad_accion_obra")
FUNCTION = ("funcion", "division_funcional", "grupo_funcional")
TARGET = ("sec_func", "meta", "finalidad", "departamento_meta")
FINANCING = ("fuente_financiamiento", "rubro", "tipo_recurso")
CLASSIFIER = ("categoria_gasto", "tipo_transaccion", "generica", "subgenerica", "subgenerica_det", "especifica", "especifica_det")
#: Codes without a description column of their own.
UNNAMED = ("sec_ejec", "tipo_act_proy", "sec_func", "finalidad")
YEAR = "ano_eje"

CODES = (*INSTITUTION, *EXECUTOR_PLACE, *PROGRAMME, *FUNCTION, *TARGET, *FINANCING, *CLASSIFIER)
NAMES = tuple(f"{c}_nombre" for c in CODES if c not in UNNAMED)
MONTHLY = tuple(f"monto_devengado_{m}" for m in MONTHS)
ANNUAL = "monto_devengado_anual"
MEASURES = (
    "monto_pia", "monto_pim", "monto_certificado_anual", "monto_comprometido_anual",
    *MONTHLY, ANNUAL, "monto_girado_anual",
)
AMOUNT = T.DecimalType(24, 2)
TOTAL = "decimal(38,2)"

MAXIMAL_KEY = (YEAR, *CODES)
#: The maximal key without columns that the executing unit determines.
BUSINESS_KEY = tuple(
    c for c in MAXIMAL_KEY if c not in ("nivel_gobierno", "sector", "pliego", *EXECUTOR_PLACE)
)


@dataclass(frozen=True)
class BlankRule:
    """Blanks of ``columns`` are structural where ``context`` has ``value``."""

    columns: tuple[str, ...]
    context: str
    value: str


# Which blanks the sources leave on purpose.
BLANK_RULES = (
    BlankRule(("sector", "sector_nombre", "pliego", "pliego_nombre"), "nivel_gobierno_nombre", "GOBIERNOS LOCALES"),
    BlankRule(("meta_nombre",), "finalidad", "99999"),
    BlankRule(("departamento_meta_nombre",), "departamento_meta", "0"),
)


@dataclass(frozen=True)
class Dimension:
    """A dimension of the star: its natural key, its attributes, and those with a default label."""

    name: str
    key: tuple[str, ...]
    attributes: tuple[str, ...] = ()
    nullable: tuple[str, ...] = ()
    labels: dict[str, tuple[str, str]] = field(default_factory=dict)
    #: Number of rows below which the dimension is numbered by one sort and broadcast.
    small: bool = True

    @property
    def surrogate(self) -> str:
        return f"{self.name}_key"


def _named(*codes: str) -> tuple[str, ...]:
    return tuple(f"{c}_nombre" for c in codes if f"{c}_nombre" in NAMES)


DIMENSIONS = (
    Dimension("tiempo", (YEAR,)),
    Dimension(
        "institucion", (YEAR, "sec_ejec"),
        ("nivel_gobierno", "sector", "pliego", "ejecutora", *_named(*INSTITUTION)),
        nullable=("sector", "sector_nombre", "pliego", "pliego_nombre"), small=False,
    ),
    Dimension(
        "meta_presupuestaria", (YEAR, "sec_ejec", *PROGRAMME, "sec_func", "meta", "finalidad"),
        (*_named(*PROGRAMME), "meta_nombre"), nullable=("meta_nombre",), small=False,
    ),
    Dimension("funcional", FUNCTION, _named(*FUNCTION)),
    Dimension("financiamiento", FINANCING, _named(*FINANCING)),
    Dimension("clasificador_gasto", (YEAR, *CLASSIFIER), _named(*CLASSIFIER)),
    Dimension("ubicacion_ejecutora", EXECUTOR_PLACE, _named(*EXECUTOR_PLACE)),
    Dimension(
        "departamento_meta", ("departamento_meta",), ("departamento_meta_nombre",),
        nullable=("departamento_meta_nombre",),
        labels={"departamento_meta_etiqueta": ("departamento_meta_nombre", "NO ESPECIFICADO")},
    ),
)


def staging_schema() -> T.StructType:
    """Year not null, texts nullable, amounts not null."""
    fields = [T.StructField(YEAR, T.ShortType(), False)]
    fields += [T.StructField(c, T.StringType(), True) for c in (*CODES, *NAMES)]
    fields += [T.StructField(c, AMOUNT, False) for c in MEASURES]
    return T.StructType(fields)


def require_columns(found: list[str], wanted) -> None:
    missing = sorted(set(wanted) - set(found))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def measures_of(columns: list[str], prefix: str = "monto_", ignore_case: bool = True) -> list[str]:
    """Columns that are amounts by their prefix; at least one is needed."""
    found = [c for c in columns if (c.lower() if ignore_case else c).startswith(prefix)]
    if not found:
        raise ValueError(f"no column starts with {prefix!r}")
    return found


def annual_of(columns: list[str], stem: str = "devengado") -> str:
    """The one annual column of a measure; none or several are an error."""
    found = [c for c in columns if c.lower() == f"monto_{stem}_anual"]
    if len(found) != 1:
        raise ValueError(f"one annual column is needed, found {len(found)}")
    return found[0]

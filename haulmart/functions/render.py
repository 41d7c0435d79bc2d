"""Display forms: rounding, labels, Spanish dates and JSON snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
DAY_NAMES = (
    "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo",
)
# Display label of every stored code, per field.
LABELS = {
    "customer_type": {
        "PREMIUM": "Premium",
        "REGULAR": "Regular",
        "OCCASIONAL": "Ocasional",
    },
    "vehicle_type": {
        "TRUCK": "Camión",
        "VAN": "Camioneta",
        "TRAILER": "Tráiler",
        "PICKUP": "Pick-up",
    },
    "fuel_type": {"DIESEL": "Diésel", "GASOLINE": "Gasolina"},
    "vehicle_status": {
        "AVAILABLE": "Disponible",
        "ON_ROUTE": "En ruta",
        "IN_MAINTENANCE": "En mantenimiento",
        "OUT_OF_SERVICE": "Fuera de servicio",
    },
    "license_type": {
        "A": "A — Automovilista",
        "B": "B — Chofer",
        "C": "C — Carga federal",
        "E": "E — Doble remolque",
    },
    "operator_status": {
        "ACTIVE": "Activo",
        "VACATION": "Vacaciones",
        "INACTIVE": "Inactivo",
    },
    "route_type": {"LOCAL": "Local", "REGIONAL": "Regional", "FORANEA": "Foránea"},
    "cause_category": {
        "EXTERNA": "Externa",
        "INTERNA": "Interna",
        "MECANICA": "Mecánica",
    },
    "delivery_status": {
        "SCHEDULED": "Programada",
        "IN_TRANSIT": "En tránsito",
        "DELIVERED": "Entregada",
        "DELAYED": "Entregada con retraso",
        "CANCELLED": "Cancelada",
    },
    "maintenance_type": {"PREVENTIVE": "Preventivo", "CORRECTIVE": "Correctivo"},
    "maintenance_status": {
        "SCHEDULED": "Programado",
        "IN_PROGRESS": "En proceso",
        "COMPLETED": "Completado",
    },
}


def rounded(value: Column, digits: int) -> Column:
    """Half-even rounding of a double, decided on its exact binary value.

    ``bround`` works on the shortest decimal text of the double and so turns
    6.35 (stored as 6.3499…) into 6.4; number formatting decides on the stored
    value and gives 6.3. Meant for a handful of report rows, not for facts.
    """
    pattern = F.lit("0." + "0" * digits)
    return F.call_function("format_number", value.cast("double"), pattern).cast("double")


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, one decimal; zero of nothing."""
    share = F.try_divide(part.cast("double"), whole.cast("double")) * 100
    return F.coalesce(rounded(share, 1), F.lit(0.0))


def mean(value: Column) -> Column:
    """Average as exact sum over count, so decimals keep every digit."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def snapshot(*fields: Column | str) -> Column:
    """JSON text of the named fields, each as a string, nulls kept."""
    named = [F.col(f) if isinstance(f, str) else f for f in fields]
    return F.to_json(
        F.struct(*[c.cast("string").alias(n) for c, n in zip(named, fields)]),
        {"ignoreNullFields": "false"},
    )


def label(value: Column, field: str) -> Column:
    """Display label of a stored code; unknown codes show as they are."""
    pairs = [F.lit(x) for pair in LABELS[field].items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value, F.lit(""))


def yes_no(flag: Column) -> Column:
    return F.when(flag, "Sí").when(~flag, "No").otherwise("")


def month_name(month: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTH_NAMES)), month.cast("int"))


def day_name(weekday: Column) -> Column:
    """Name of a weekday counted from Monday = 0."""
    return F.element_at(F.array(*map(F.lit, DAY_NAMES)), weekday.cast("int") + 1)


def spell_date(day: Column) -> Column:
    """"5 de enero de 2026"."""
    return F.concat_ws(
        " de ",
        F.dayofmonth(day).cast("string"),
        F.lower(month_name(F.month(day))),
        F.year(day).cast("string"),
    )


def spell(day: dt.date) -> str:
    return f"{day.day} de {MONTH_NAMES[day.month - 1].lower()} de {day.year}"

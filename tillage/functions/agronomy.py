"""Row-level formulas and classifications as column expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exchange rate and kilograms per trading unit.
USD_TO_EUR = 0.92
KG_PER_UNIT = {"CORN": 25.4, "WHEAT": 27.2, "SOYBEANS": 27.2, "COTTON": 0.453}

# Crop to commodity, and static prices (EUR/kg) of crops without a future.
CROP_COMMODITY = {"Maize": "CORN", "Wheat": "WHEAT", "Soybean": "SOYBEANS", "Cotton": "COTTON"}
STATIC_PRICES = {
    "Rice": 0.45,
    "Barley": 0.14,
    "Olives": 1.50,
    "Citrus": 0.85,
    "Tomatoes": 1.45,
    "Potatoes": 0.25,
}
RICE_BASE_PRICE = 0.45
RICE_VOLATILITY = 0.10

# Regions written without a country suffix.
REGION_COUNTRY = {
    "North India": "India",
    "South India": "India",
    "East Africa": "Kenya",
    "Kenya Highlands": "Kenya",
    "Nigeria North": "Nigeria",
    "Central USA": "USA",
    "South USA": "USA",
    "Central Thailand": "Thailand",
    "South Africa Cape": "South Africa",
}

SEVERITY_ORDER = ["No Disease", "Mild", "Moderate", "Severe"]

# Base yields of the rule-based score.
BASE_YIELDS = {"Wheat": 3500, "Corn": 4500, "Rice": 4200, "Soybean": 2800, "Barley": 3200}
DEFAULT_BASE_YIELD = 3500

# Defaults of a scoring request.
INPUT_DEFAULTS = {
    "soil_moisture_pct": 50.0,
    "soil_pH": 6.5,
    "temperature_C": 25.0,
    "rainfall_mm": 500.0,
    "humidity_pct": 65.0,
    "sunlight_hours": 8.0,
    "pesticide_usage_ml": 100.0,
    "NDVI_index": 0.7,
    "total_days": 120,
    "region": "North",
    "crop_type": "Wheat",
    "irrigation_type": "Drip",
    "fertilizer_type": "Organic",
    "crop_disease_status": "No Disease",
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def literal_map(mapping: dict) -> Column:
    """A dict as a map literal; the dict is a fixed lookup, never data."""
    return F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])


# ---- prices ---------------------------------------------------------------------------


def cents_to_eur_per_kg(cents, kg_per_unit: float) -> Column:
    return _c(cents) / F.lit(100) * F.lit(USD_TO_EUR) / F.lit(kg_per_unit)


def seasonal_price(day, base: float = RICE_BASE_PRICE, volatility: float = RICE_VOLATILITY) -> Column:
    """Seasonal baseline, held within 30 % of the base price."""
    wave = F.sin(F.lit(2.0) * F.pi() * F.dayofyear(_c(day)) / F.lit(365))
    price = F.lit(base) * (F.lit(1) + F.lit(volatility) * wave)
    return F.greatest(F.lit(base * 0.7), F.least(F.lit(base * 1.3), price))


def crop_price(crop, average_of, mapping=None, static=None, fallback=RICE_BASE_PRICE, rice=None) -> Column:
    """Three-level price lookup.

    ``average_of`` maps a commodity name to its average column. A mapped crop takes the
    average of its commodity, or 0 when there is none; a crop with a static price takes
    that; any other crop takes the rice average, or ``fallback``.
    """
    mapping = CROP_COMMODITY if mapping is None else mapping
    static = STATIC_PRICES if static is None else static
    price = F.coalesce(rice, F.lit(fallback)) if rice is not None else F.lit(fallback)
    price = F.coalesce(literal_map(static)[_c(crop)], price) if static else price
    expr = None
    for name, commodity in mapping.items():
        value = average_of.get(commodity)
        value = F.coalesce(value, F.lit(0.0)) if value is not None else F.lit(0.0)
        hit = _c(crop) == F.lit(name)
        expr = F.when(hit, value) if expr is None else expr.when(hit, value)
    return price if expr is None else expr.otherwise(price)


# ---- derived measures -------------------------------------------------------------------


def yield_per_day(y="yield_kg_per_hectare", days="total_days") -> Column:
    return F.try_divide(_c(y), _c(days))


def per_unit_plus_one(y, x) -> Column:
    """Efficiency with a +1 guard in the denominator."""
    return _c(y) / (_c(x) + F.lit(1))


def heat_stress(t="temperature_C") -> Column:
    return F.coalesce((_c(t) > 32).cast("int"), F.lit(0))


def drought_stress(m="soil_moisture_pct") -> Column:
    return F.coalesce((_c(m) < 20).cast("int"), F.lit(0))


def growing_score(m="soil_moisture_pct", ph="soil_pH", t="temperature_C", ndvi="NDVI_index") -> Column:
    """Four terms of 25 points, clipped to 0..100; a missing input gives a missing score."""
    raw = (
        _c(m) / 45 * 25
        + (1 - F.abs(_c(ph) - 6.5) / 1.5) * 25
        + (1 - F.abs(_c(t) - 25) / 10) * 25
        + _c(ndvi) * 25
    )
    return F.when(raw.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), raw)))


def season(month) -> Column:
    m = _c(month)
    return (
        F.when(m.between(3, 5), "Spring")
        .when(m.between(6, 8), "Summer")
        .when(m.between(9, 11), "Fall")
        .otherwise("Winter")
    )


def country_of(region, mapping=None) -> Column:
    """Text after the last comma, else the mapped country, else the region itself."""
    r = _c(region)
    known = literal_map(REGION_COUNTRY if mapping is None else mapping)[r]
    return F.when(r.contains(","), F.trim(F.substring_index(r, ",", -1))).otherwise(F.coalesce(known, r))


# ---- binning and labels -----------------------------------------------------------------


def bin_right_closed(x, edges, labels) -> Column:
    """Labels for (-inf, e1], (e1, e2], ..., (ek, inf); missing stays missing."""
    x = _c(x)
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        expr = expr.when(x <= (edge if isinstance(edge, Column) else F.lit(edge)), label)
    return expr.otherwise(labels[-1])


TEMPERATURE_BUCKETS = ["<20°C", "20-25°C", "25-30°C", ">30°C"]
MOISTURE_BUCKETS = ["<30%", "30-50%", "50-70%", ">70%"]


def climate_bucket(x, edges, labels) -> Column:
    """First bucket open at its end, the others closed; values of 0 or less are dropped."""
    x = _c(x)
    first, second, third = edges
    return (
        F.when((x > 0) & (x < first), labels[0])
        .when((x >= first) & (x <= second), labels[1])
        .when((x > second) & (x <= third), labels[2])
        .when(x > third, labels[3])
    )


def temperature_bucket(x="temperature_C") -> Column:
    return climate_bucket(x, (20, 25, 30), TEMPERATURE_BUCKETS)


def moisture_bucket(x="soil_moisture_pct") -> Column:
    return climate_bucket(x, (30, 50, 70), MOISTURE_BUCKETS)


def yield_class(y="yield_kg_per_hectare") -> Column:
    y = _c(y)
    return (
        F.when(y.isNull() | F.isnan(y) | (y == 0), "muted")
        .when(y >= 5000, "success")
        .when(y >= 3000, "warning")
        .otherwise("danger")
    )


def disease_class(status="crop_disease_status", bilingual: bool = False) -> Column:
    """First matching word wins; ``bilingual`` also knows the French words."""
    s = F.lower(_c(status))
    ladder = [
        ("success", ["no disease", "healthy"], ["sain"]),
        ("info", ["mild"], ["léger"]),
        ("warning", ["moderate"], ["modéré"]),
        ("danger", ["severe"], ["sévère"]),
    ]
    expr = F.when(s.isNull() | (s == ""), "secondary")
    for label, words, more in ladder:
        hit = F.lit(False)
        for word in words + (more if bilingual else []):
            hit = hit | s.contains(word)
        expr = expr.when(hit, label)
    return expr.otherwise("secondary")


def strength_three(r) -> Column:
    """Weak / Moderate / Strong at 0.3 and 0.5 (open)."""
    a = F.abs(_c(r))
    return F.when(a > 0.5, "Strong").when(a > 0.3, "Moderate").otherwise("Weak")


def strength_four(r) -> Column:
    """Not significant / weak / moderate / strong at 0.3, 0.5 and 0.8 (closed)."""
    a = F.abs(_c(r))
    return F.when(a >= 0.8, "strong").when(a >= 0.5, "moderate").when(a >= 0.3, "weak").otherwise("none")


def severity_rank(status, order=None) -> Column:
    """Position in the severity order, missing when unknown."""
    pos = F.array_position(F.array(*[F.lit(x) for x in (order or SEVERITY_ORDER)]), _c(status))
    return F.when(pos > 0, pos)


def synthetic_risk(humidity="humidity_pct", temperature="temperature_C") -> Column:
    """Risk label used when no status exists. The later Medium rule covers every row
    the High rule could mark, so High never remains."""
    h, t = _c(humidity), _c(temperature)
    return F.when((h > 70) | (t > 28), "Medium").when((h > 80) & (t > 30), "High").otherwise("Low")


# ---- transactions and rules text ----------------------------------------------------------


def transaction_items(columns) -> Column:
    """``col=value`` items in column order, missing values skipped."""
    items = F.array(*[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in columns])
    return F.filter(items, lambda x: x.isNotNull())


def item_values(items) -> Column:
    """Items without their ``col=`` prefix."""
    return F.transform(
        _c(items), lambda x: F.when(x.contains("="), F.split(x, "=")[1]).otherwise(x)
    )


def item_text(items) -> Column:
    return F.array_join(item_values(items), ", ")


# ---- rule-based score and recommendations ---------------------------------------------------


def with_input_defaults(df, defaults=None):
    """Fill absent columns and missing values with the request defaults."""
    defaults = INPUT_DEFAULTS if defaults is None else defaults
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v)
            for c, v in defaults.items()
        }
    )


def rule_adjustment() -> Column:
    m, ph = F.col("soil_moisture_pct"), F.col("soil_pH")
    disease, irrigation = F.col("crop_disease_status"), F.col("irrigation_type")
    moisture = F.when(m < 30, -0.3).when(m > 70, -0.2).when(m.between(40, 60), 0.1).otherwise(0.0)
    acidity = F.when(ph.between(6.0, 7.0), 0.1).when((ph < 5.5) | (ph > 7.5), -0.2).otherwise(0.0)
    health = (
        F.when(disease == "Severe", -0.4)
        .when(disease == "Moderate", -0.2)
        .when(disease == "Mild", -0.1)
        .otherwise(0.0)
    )
    water = F.when(irrigation == "Drip", 0.15).when(irrigation == "Sprinkler", 0.1).otherwise(0.0)
    return moisture + acidity + health + water


def rule_score(base_yields=None) -> Column:
    """Base yield of the crop, scaled by soil, disease and irrigation adjustments."""
    base = F.coalesce(
        literal_map(BASE_YIELDS if base_yields is None else base_yields)[F.col("crop_type")],
        F.lit(DEFAULT_BASE_YIELD),
    )
    return base * (1 + rule_adjustment())


def _advice(category, message, priority, impact) -> Column:
    text = message if isinstance(message, Column) else F.lit(message)
    return F.struct(
        F.lit(category).alias("category"),
        text.alias("message"),
        F.lit(priority).alias("priority"),
        F.lit(impact).alias("expected_impact"),
    )


def recommendations() -> Column:
    """Up to five pieces of advice per row, filled up to three with general ones."""
    m, ph, ndvi = F.col("soil_moisture_pct"), F.col("soil_pH"), F.col("NDVI_index")
    disease, irrigation = F.col("crop_disease_status"), F.col("irrigation_type")
    specific = F.array_compact(
        F.array(
            F.when(
                m < 30,
                _advice("Irrigation", "Soil moisture is very low. Increase irrigation.", "High", "+15-20%"),
            ).when(
                m > 70,
                _advice("Drainage", "Soil moisture is very high. Improve drainage.", "Medium", "+5-10%"),
            ),
            F.when(
                ph < 6.0,
                _advice("Soil Management", "Soil pH is acidic. Consider adding lime.", "High", "+10-15%"),
            ).when(
                ph > 7.5,
                _advice("Soil Management", "Soil pH is alkaline. Consider adding sulfur.", "High", "+10-15%"),
            ),
            F.when(
                disease != "No Disease",
                _advice(
                    "Disease Control",
                    F.concat(F.lit("Crop disease detected ("), disease, F.lit("). Apply appropriate treatment.")),
                    "High",
                    "+20-30%",
                ),
            ),
            F.when(
                ndvi < 0.4,
                _advice("Crop Health", "Low vegetation health (NDVI). Check nutrient levels.", "Medium", "+10-15%"),
            ),
            F.when(
                irrigation.isin("No Irrigation", "Flood"),
                _advice(
                    "Irrigation",
                    "Consider upgrading to drip or sprinkler irrigation for better efficiency.",
                    "Medium",
                    "+10-20%",
                ),
            ),
        )
    )
    general = F.array(
        _advice(
            "Fertilization",
            "Regular soil testing and balanced fertilization can improve yield.",
            "Medium",
            "+10-15%",
        ),
        _advice("Crop Rotation", "Implement crop rotation to maintain soil health.", "Low", "+5-10%"),
        _advice("Pest Management", "Regular monitoring and integrated pest management.", "Medium", "+5-15%"),
    )
    missing = F.greatest(F.lit(3) - F.size(specific), F.lit(0))
    return F.slice(F.concat(specific, F.slice(general, F.lit(1), missing)), 1, 5)


# ---- comparison labels ------------------------------------------------------------------------


def performance_label(diff_pct) -> Column:
    d = _c(diff_pct)
    return (
        F.when(d > 20, "Excellent").when(d > 0, "Good").when(d > -10, "Average").otherwise("Below Average")
    )


def attainment_label(pct) -> Column:
    p = _c(pct)
    return (
        F.when(p >= 120, "Excellent - Well above regional average")
        .when(p >= 100, "Good - Above regional average")
        .when(p >= 80, "Average - Near regional average")
        .otherwise("Below regional average")
    )


def confidence_level(confidence) -> Column:
    c = _c(confidence)
    return F.when(c > 0.8, "success").when(c > 0.6, "warning").otherwise("danger")

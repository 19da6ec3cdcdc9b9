"""Clinical recodes: demographics, stage, histotype, grade, drug names, markers.

The label lists are fixed values that results depend on; they are stated as
plain tables. The expressions below read those tables.
"""

from __future__ import annotations


from functools import reduce

from pyspark.sql import Column, functions as F

from kohorta.functions import exprs as x
from kohorta.functions.recode import domain, equals_any, recode

UNKNOWN = "Unknown/Not Applicable"
MIGRATED = "(Migrated) Cannot determine from available documentation"

# Body mass index classes.
BMI_CUTS = [18.5, 25, 30]
BMI_LABELS = ["Underweight", "Healthy", "Overweight", "Obese"]
BMI_GROUPS = ["Underweight - Healthy", "Overweight", "Obese"]

# Race labels per group (exact labels, then substrings).
RACE_GROUPS: list[tuple[str, list[str], list[str]]] = [
    ("American Indian or Alaska Native", [], ["American Indian"]),
    ("White", ["White"], []),
    ("Black", ["Black"], []),
    (
        "Asian",
        ["Chinese", "Filipino", "Japanese", "Korean", "Pakistani", "Thai", "Vietnamese", "Laotian"],
        ["Asian", "Cambodian"],
    ),
    (
        "Native Hawaiian or Other Pacific Islander",
        ["Hawaiian", "Micronesian, NOS", "Pacific Islander, NOS", "Polynesian, NOS", "Samoan"],
        ["Tongan"],
    ),
    ("Unknown", ["Other"], ["Unknown"]),
]
RACE_ETH_LEVELS = ["White Non-Hispanic", "Black Non-Hispanic", "Hispanic any race"]

# Sites that make a diagnosis an index event.
INDEX_SITES = ["Ovary", "Fallopian tube", "Peritoneum, NOS", "Specified parts of peritoneum"]
INDEX_SITE_WITH_HISTOLOGY = (
    "Overlapping lesion of female genital organs",
    "Serous cystadenocarcinoma, NOS",
)

# Salt and formulation words in drug names; the first one found is removed.
DRUG_SUFFIXES = (
    " Hydrochloride|Liposomal | Sulfate| Phosphate| Citrate| Acetate| Camsylate"
    "| Disodium| Mesylate| Ditosylate| Tosylate| Tartrate"
)

# Drugs added to the drug class dimension (name, narrow class, general class).
ADDED_DRUG_CLASSES = [
    ("Denosumab", "targeted_therapy", "targeted_therapy"),
    ("Gemtuzumab Ozogamicin", "targeted_therapy", "targeted_therapy"),
    ("Altretamine", "alkylating_agent", "cytotoxic_therapy"),
    ("Interferon", "immune_therapy", "immune_therapy"),
    ("Trifluridine", "antimetabolite", "cytotoxic_therapy"),
    ("Raloxifene", "hormonal_therapy", "hormonal_therapy"),
    ("Lanreotide", "targeted_therapy", "targeted_therapy"),
]

# Stage by the roman numeral it contains, tested in this order.
STAGE_NUMERALS = [("IV", "4"), ("V", "5"), ("III", "3"), ("II", "2"), ("I", "1")]
STAGE_GROUPS = {"1": "1-2", "2": "1-2", "3": "3-4", "4": "3-4"}

# Histotype by (sequencing histology, clinical histology).
HISTOTYPE_BY_BOTH = {
    ("Endometrioid adenocarcinoma, NOS", "Adenocarcinoma, NOS"): "Endometrioid",
    ("Endometrioid adenocarcinoma, NOS", "Mixed cell adenocarcinoma"): "Endometrioid",
    ("Endometrioid adenocarcinoma, NOS", "Other"): "Endometrioid",
    (
        "Serous surface papillary tumor of borderline malignancy",
        "Serous cystadenoma, borderline malignancy",
    ): "Exclude",
    ("Serous cystadenocarcinoma, NOS", "Neoplasm, malignant"): "Serous",
    (
        "Serous surface papillary carcinoma",
        "Serous endometrial/tubal intraepithelial carcinoma",
    ): "Serous",
    ("Clear cell adenocarcinoma, NOS", "Clear cell adenocarcinofibroma"): "Clear cell",
    ("Pseudomyxoma peritonei", "Adenocarcinoma, intestinal type"): "Mucinous",
}

# Histotype by clinical histology alone.
HISTOTYPE_LABELS: dict[str, list[str]] = {
    "Serous": [
        "Serous cystadenocarcinoma, NOS",
        "Papillary serous cystadenocarcinoma",
        "Serous surface papillary carcinoma",
        "Papillary adenocarcinoma, NOS",
        "Transitional cell carcinoma, NOS",
        "Papillary carcinoma, NOS",
    ],
    "Endometrioid": ["Endometrioid adenocarcinoma, NOS"],
    "Clear cell": ["Clear cell adenocarcinoma, NOS"],
    "Mucinous": ["Mucinous adenocarcinoma", "Mucinous cystadenocarcinoma, NOS"],
    "Other epithelial": [
        "Mixed cell adenocarcinoma",
        "Adenocarcinoma, NOS",
        "Carcinosarcoma, NOS",
        "Carcinoma, NOS",
        "Mullerian mixed tumor",
        "Carcinoma, metastatic, NOS",
        "Squamous cell carcinoma, NOS",
        "Carcinoma, anaplastic, NOS",
        "Mesodermal mixed tumor",
        "Adenocarcinoma in situ, NOS",
        "Large cell carcinoma, NOS",
        "Small cell carcinoma, NOS",
    ],
    "Serous but not invasive so probably exclude?": ["Serous cystadenoma, borderline malignancy"],
    "Exclude": [
        "Neoplasm, malignant",
        "Clear cell adenocarcinofibroma",
        "Serous endometrial/tubal intraepithelial carcinoma",
        "Granulosa cell tumor, malignant",
        "Sertoli-leydig cell tumor, poorly differentiated",
        "Sertoli cell carcinoma",
        "Mucinous cystic tumor of borderline malignancy",
        "Other",
        "Sebaceous adenocarcinoma",
        "Thecoma, malignant",
        "Dysgerminoma",
        "Mixed germ cell tumor",
        "Steroid cell tumor, malignant",
    ],
}

# Grade of serous tumours; an unknown grade counts as high.
GRADES = {
    "Low": ["Low grade", "Well differentiated"],
    "High": [
        "High grade",
        "Moderately differentiated",
        "Poorly differentiated",
        "Undifferentiated",
        "Grade cannot be assessed; Unknown",
        "Site-specific grade system category",
        "Unknown/Not Applicable",
    ],
}
HIGH_GRADE_GROUP = "High-grade serous/carcinosarcoma"

# Sequencing histologies kept in the reports.
KEPT_HISTOLOGIES = [
    "80103 Carcinoma, NOS",
    "80213 Carcinoma, anaplastic, NOS",
    "80703 Squamous cell carcinoma, NOS",
    "81203 Transitional cell carcinoma, NOS",
    "81403 Adenocarcinoma, NOS",
    "82603 Papillary adenocarcinoma, NOS",
    "83103 Clear cell adenocarcinoma, NOS",
    "83233 Mixed cell adenocarcinoma",
    "83803 Endometrioid adenocarcinoma, NOS",
    "84413 Serous carcinoma, NOS",
    "84413 Serous cystadenocarcinoma, NOS",
    "84503 Papillary cystadenocarcinoma, NOS",
    "84603 Low grade serous carcinoma",
    "84603 Papillary serous cystadenocarcinoma",
    "84613 High grade serous carcinoma",
    "84613 Serous surface papillary carcinoma",
    "84703 Mucinous cystadenocarcinoma, NOS",
    "84803 Mucinous adenocarcinoma",
    "84806 Pseudomyxoma peritonei",
    "89503 Mullerian mixed tumor",
    "89803 Carcinosarcoma, NOS",
]


def race_group(race: Column) -> Column:
    rules = [(equals_any(race, exact, parts), group) for group, exact, parts in RACE_GROUPS]
    return recode(rules, default=race)


def ethnicity_group(ethnicity: Column) -> Column:
    return recode(
        [
            (equals_any(ethnicity, ["Spanish surname only"], ["Non-Hispanic"]), "Non-Hispanic"),
            (ethnicity.contains("Unknown"), "Unknown"),
            (ethnicity.isNotNull(), "Hispanic"),
        ]
    )


def race_ethnicity(race: Column, ethnicity: Column) -> Column:
    """Joint group of the grouped race and ethnicity; other pairs stay unset."""
    single = F.when(
        race.isin("White", "Black", "Others") & (ethnicity == "Non-Hispanic"),
        F.concat(race, F.lit(" Non-Hispanic")),
    )
    return F.coalesce(single, F.when(ethnicity == "Hispanic", F.lit("Hispanic any race")))


def smoking_group(status: Column) -> Column:
    rules = [(status == "Never", "Never"), (equals_any(status, ["Current"], ["Ever"]), "Ever")]
    return recode(rules)


def is_index_site(site: Column, histology: Column) -> Column:
    with_site, with_histology = INDEX_SITE_WITH_HISTOLOGY
    return site.isin(*INDEX_SITES) | ((site == with_site) & (histology == with_histology))


def drug_name(name: Column) -> Column:
    """Drug name without salt words, variants merged."""
    # Few names hold such a word, and looking for the words is cheaper than the pattern.
    salted = reduce(lambda a, b: a | b, [name.contains(word) for word in DRUG_SUFFIXES.split("|")])
    stem = F.when(salted, x.remove_first(name, DRUG_SUFFIXES)).otherwise(name)
    return (
        F.when(stem.contains("Paclitaxel"), F.lit("Paclitaxel"))
        .when(stem == "Interferon, NOS", F.lit("Interferon"))
        .otherwise(stem)
    )


def chemotherapy_flag(narrow_class: Column, name: Column) -> Column:
    return F.when(narrow_class.isNotNull() | (name == "chemo, nos"), F.lit("Ever"))


def outcome_event(indicator: Column) -> Column:
    """1 for progression or recurrence, 0 for none, null when unknown."""
    return F.when(indicator.isin("Progression", "Recurrence"), 1).when(indicator == "No", 0)


def bmi_group(category: Column) -> Column:
    merged = F.when(category.isin("Underweight", "Healthy"), F.lit(BMI_GROUPS[0])).otherwise(category)
    return domain(merged, BMI_GROUPS)


def stage_number(stage: Column) -> Column:
    return recode([(stage.contains(text), number) for text, number in STAGE_NUMERALS])


def stage_group(stage: Column) -> Column:
    return recode([(stage == number, group) for number, group in STAGE_GROUPS.items()])


def histology_name(text: Column) -> Column:
    """Name after the code; the digit run that is looked for holds no zero."""
    return x.capture(text, "[1-9]+ (.*)", 1)


def histotype(behavior: Column, histology: Column) -> Column:
    """Histotype; a rule on both columns comes before one on the histology alone."""
    rules = [
        ((behavior == b) & (histology == h), value) for (b, h), value in HISTOTYPE_BY_BOTH.items()
    ]
    rules += [(histology.isin(*labels), value) for value, labels in HISTOTYPE_LABELS.items()]
    return recode(rules)


def serous_grade(histotype_: Column, grade: Column) -> Column:
    rules = [((histotype_ == "Serous") & grade.isin(*labels), level) for level, labels in GRADES.items()]
    return recode(rules)


def outcome_group(grade: Column, histology: Column, histotype_: Column) -> Column:
    return recode(
        [
            ((grade == "High") | (histology == "Carcinosarcoma, NOS"), HIGH_GRADE_GROUP),
            (histotype_ == "Exclude", "Exclude"),
            (grade.isNotNull() | histotype_.isNotNull(), "Others"),
        ]
    )


def marker_value(
    result: Column,
    value: Column,
    low: Column,
    high: Column,
    indicator: Column,
    lexical: bool = False,
) -> Column:
    """Readable marker result: the label, or the value with its interpretation."""
    number = F.when(result == "Value", value)
    meaning = x.in_range_label(number, low, high, indicator, lexical=lexical)
    text = F.coalesce(x.concat_strict(number, meaning, sep=" : "), number, meaning)
    return F.coalesce(x.na_if(result, "Value"), text)


def marker_parts(test: Column, result: Column) -> tuple[Column, Column]:
    """Assay name and result of a receptor test whose method follows its name.

    An amplified receptor is positive; "Not Amplified" is left as it is.
    """
    receptor = test.contains("HER2")
    method = F.when(receptor, x.capture(test, "(HER2Neu) (.*)", 2))
    name = F.when(receptor, x.capture(test, "(HER2Neu) (.*)", 1)).otherwise(test)
    full = F.when(method.isNull(), result).otherwise(x.concat_strict(method, result, sep=" : "))
    amplified = name.contains("HER2") & full.rlike("(^|: )Amplified")
    return name, F.when(amplified, F.lit("Positive")).otherwise(full)



"""Ordered rules that categorise microbiology culture text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartloom.functions.text import first_match

# ---- fixed values: (pattern, category), first match wins, case ignored ----
METHOD_RULES = [
    ("cult", "culture"),
    ("stain", "gram stain"),
    ("smear", "smear"),
]

FLUID_NAME_RULES = [
    ("brain", "brain"),
    ("blood", "blood/buffy coat"),
    ("marrow", "bone marrow"),
    ("bone|skull flap|vertebra|disc, ", "bone cortex (osteomyelitis)"),
    ("aortic|mitral|tricuspid|pericardial|pericardium|vegetation|vegetations|leaflet|leaflets|endocarditis|endocardial|endocardium|myocardium|heart", "cardiac (endocardium, myocardium, pericardium)"),
    (r"\btip\b|\bwire\b|\blead\b|generator", "catheter tip"),
    (r"auricular|\bear\b|\bears\b", "ears"),
    ("esophagus|esophageal|esophogeal|oesophagus|oesophageal", "esophagus"),
    (r"conjunctiva|conjunctival|cornea|corneal|vitreous|right eye|left eye|\beye\b|\beyes\b|supraorbital|infraorbital|orbital|lacrimal gland|lens", "eyes"),
    ("stool|feces|faeces|faecal|fecal|rectal swab", "feces/stool"),
    (r"bile|bilious|biliary|bilary|bile drain|\bchole\b|chole drain|cholecystectomy drain|choletube|cholecystostomy|cholecystosotmy|gallbladder|gall bladder|galbladder|gallblader|galblader|\bgb\|pancreas|pancritic|pancreatic|peripancreatic|peripancreatric", "gallbladder and billary tree (not hepatitis), pancreas"),
    ("abdominal fluid|fluid, abdominal", "gastrointestinal tract unspecified"),
    (r"genital|scrotum|scrotal|\blabia\b|\bvulva\b|penile|pennile|pennis|penis|urethral|perineum|urethra|foreskin", "genital area"),
    (r"kidney aspirate|ureter|kidney|cystoscop|renal|nephric|ureter|ureterostomy|\bbladder\b", "kidneys, renal pelvis, ureters and bladder"),
    ("foley|urine|mid stream|straight cath|nephrostomy|pcn|pcnu|neph. tube", "genito-urinary tract unspecified"),
    ("synovial|snyovial|synovium|capsule|casule|knee fluid|kne fluid|knee fl|knee aspiration|shoulder fluid|shoulder aspiration|ankle fluid|ankle aspiration|acetabular fluid|acetabular joint|hip joint|hip aspiration|joint fluid|joint (synovial) fluid|bursitis|prosthetic|tendon|femoral head, ", "joints"),
    ("larynx|laryngeal|laryndeal|epiglottis", "larynx"),
    ("appendi|large bowel|large intesti|paracolic gutter", "large intestine"),
    ("hepatic|peri portal|liver", "liver"),
    ("lymphatic|lymph node|lymphadenopathy|lymphadenitis", "lymph nodes"),
    (r"endotracheal|endptracheal|\bett\b|endotracheal aspirate|trach|tracheal|tracheostomy|sputum|hypertonic saline|rubber|tracheostom|induced|sputum", "respiratory tract unspecified"),
    ("broncho-alveolar|bronchoalveolar|bronchial|bronchoscopy|bronchoscopic|bronchial|lung|bronchus", "lower respiratory tract (lung)"),
    ("csf|cerebrospinal fluid|cerebral spinal fluid|epidural|subdural|evd output|tube 1|tube 2|tube 3", "meninges and csf"),
    (r"\bnose\b|nasal|nares|nasopharynx|nasopharyngeal|naris|adenoids", "upper airway and nasopharynx"),
    ("mouth|tongue|throat|oropharyngeal|oropharynx|tonsil|oral cavity", "tongue, oral cavity, and oro-pharynx"),
    ("ascitic|ascites|ascietes|ascities|acites|ascitic|pd catheter|dialysate|paracentesis|peritoneal|fluid, pd|peritonial|peritoenal|pertioneal|peritoneum|intraperitoneal|retroperitoneal|fluid, dialysis", "peritoneum"),
    (r"pleura|pleural|pluera|plueral|hydropneumothorax|chest fluid|chest tube|ct 1|ct 2|ct 3|\bct\b|thoracentesis|thora|pleurx|pleurex|empyema", "pleural cavity, pleural fluid"),
    ("pustule|pustules|rash", "rash, pustules, or abscesses not typical of any of the above"),
    ("sinus", "sinuses"),
    (r"\bskin\b", "skin unspecified"),
    ("small bowel", "small intestine"),
    ("splenic|spleen", "spleen"),
    ("gastric|stomach", "stomach"),
    ("testis|testicular|testicle|testes|fluid, seminal", "testes"),
    (r"\bwd\b|wound|driveline|drive line|incision", "woundsite"),
    ("vagina", "vagina"),
]

ORDER_NAME_RULES = [
    ("wound", "woundsite"),
    ("genital", "genital area"),
    ("urine", "genito-urinary tract unspecified"),
    ("skin", "skin unspecified"),
    ("vagina", "vagina"),
    ("culture blood", "blood/buffy coat"),
]

FLUID_OVERRIDE_RULES = [
    ("urine cystosc", "kidneys, renal pelvis, ureters and bladder"),
    ("catheter tip", "catheter tip"),
    ("csf", "meninges and csf"),
    ("sputum", "respiratory tract unspecified"),
]

METHOD_OVERRIDE_RULES = [
    ("respiratory bronchial culture", "lower respiratory tract (lung)"),
    ("catheter tip", "catheter tip"),
    ("csf", "meninges and csf"),
]

ANTIBIOTIC_EXACT = {
    "beta-lactams": "beta_lactams",
    "cefotaxime/clavulanate": "cefotaxime_clavulanate",
    "ceftazidime/avibactam": "ceftazidime_avibactam",
    "ceftolozane/tazobactam": "ceftolozane_tazobactam",
    "inducible macrolide resistance test (imlsb)": "macrolides",
    "piperacillin/tazobactam": "piperacillin_tazobactam",
    "trimethoprim/sulfamethoxazole": "trimethoprim_sulfamethoxazole",
}

ANTIBIOTIC_RULES = [
    ("flucytosine", "flucytosine"),
    ("amoxicillin/clavulan", "amoxicillin_clavulanate"),
    ("amphotericin b", "amphotericin_b"),
    ("ampicillin/sulbactam", "ampicillin_sulbactam"),
    ("cefotaxime", "cefotaxime"),
    ("ceftazidime/avibactam", "ceftazidime_avibactam"),
    ("ceftriaxone", "ceftriaxone"),
    ("cefuroxime ", "cefuroxime "),
    ("ethambutol", "ethambutol"),
    ("gentamicin", "gentamicin"),
    ("clindamycin", "clindamycin"),
    ("isoniazid ", "isoniazid "),
    ("meropenem/vaborbactam", "meropenem_vaborbactam"),
    ("penicillin", "penicillin"),
    ("pyrazinamide", "pyrazinamide"),
    ("rifampin", "rifampin"),
    ("streptomycin", "streptomycin"),
    ("synercid (quinupristin/dalfop.)", "quinupristin_dalfopristin"),
    ("tetracycline", "tetracyclines"),
]

SUSCEPTIBILITY = {
    "susceptible": "susceptible",
    "resistant": "non_susceptible",
    "intermediate": "intermediate",
    "susceptible dose dependent": "susceptible",
    "non-susceptible": "non_susceptible",
}

FLUID_FALLBACK = "other unspecified"
# ---- end of fixed values ----


def method_category(method_name: Column) -> Column:
    return first_match(method_name, METHOD_RULES, ignore_case=True)


def fluid_category(fluid_name: Column, order_name: Column, method_name: Column, current: Column | None = None) -> Column:
    """Later sources override earlier ones: method over order and fluid overrides over fluid name."""
    current = F.lit(None).cast("string") if current is None else current
    return F.coalesce(
        first_match(method_name, METHOD_OVERRIDE_RULES, ignore_case=True),
        first_match(order_name, ORDER_NAME_RULES, ignore_case=True),
        first_match(fluid_name, FLUID_OVERRIDE_RULES, ignore_case=True),
        first_match(fluid_name, FLUID_NAME_RULES, ignore_case=True),
        current,
        F.lit(FLUID_FALLBACK),
    )


def _exact(col: Column, mapping: dict[str, str]) -> Column:
    key = F.lower(F.trim(col))
    out = None
    for name, category in mapping.items():
        out = F.when(key == name, category) if out is None else out.when(key == name, category)
    return out


def antibiotic_category(name: Column) -> Column:
    return F.coalesce(_exact(name, ANTIBIOTIC_EXACT), first_match(name, ANTIBIOTIC_RULES, ignore_case=True), name)


def susceptibility_category(name: Column) -> Column:
    return _exact(name, SUSCEPTIBILITY)

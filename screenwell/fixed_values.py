"""Names, cut-offs, word lists, patterns and messages that results depend on.

Nothing here is logic. Every function that uses one of these tables takes it as a default
argument, so another instrument or vocabulary can be passed in.
"""

# --- Questionnaire items (fixed values) ---
PHQ_ITEMS = [
    "phq1_anhedonia", "phq2_low_mood", "phq3_sleep", "phq4_fatigue", "phq5_appetite",
    "phq6_self_worth", "phq7_concentration", "phq8_psychomotor", "phq9_suicidal_ideation",
]
GAD_ITEMS = [
    "gad1_nervous", "gad2_uncontrollable_worry", "gad3_excess_worry", "gad4_trouble_relaxing",
    "gad5_restless", "gad6_irritable", "gad7_fearful",
]
ALL_ITEMS = PHQ_ITEMS + GAD_ITEMS
IDEATION_ITEM = "phq9_suicidal_ideation"

# --- Severity bands as (low, high, name) (fixed values) ---
PHQ_BANDS = [(0, 4, "none"), (5, 9, "mild"), (10, 14, "moderate"),
             (15, 19, "moderately_severe"), (20, 27, "severe")]
GAD_BANDS = [(0, 4, "minimal"), (5, 9, "mild"), (10, 14, "moderate"), (15, 21, "severe")]
AGE_BANDS = [(0, 29, "18-29"), (30, 44, "30-44"), (45, 59, "45-59"), (60, 200, "60+")]
BAND_SCORES = {"none": 0.0, "minimal": 0.0, "mild": 0.25, "moderate": 0.5,
               "moderately_severe": 0.75, "severe": 1.0}
BAND_ORDER = ["none", "mild", "moderate", "moderately_severe", "severe"]
RAISED_PHQ_BANDS = ["moderate", "moderately_severe", "severe"]
RAISED_GAD_BANDS = ["moderate", "severe"]
VERDICTS = ["escalate", "monitor", "routine"]

# --- Item contribution labels and weights (fixed values) ---
ITEM_WEIGHTS = [
    ("phq1_anhedonia", "Anhedonia (Q1)", 1.0),
    ("phq2_low_mood", "Low mood (Q2)", 1.0),
    ("phq3_sleep", "Sleep disruption (Q3)", 0.85),
    ("phq4_fatigue", "Fatigue (Q4)", 0.85),
    ("phq5_appetite", "Appetite change (Q5)", 0.8),
    ("phq6_self_worth", "Self-worth / guilt (Q6)", 0.9),
    ("phq7_concentration", "Concentration (Q7)", 0.8),
    ("phq8_psychomotor", "Psychomotor change (Q8)", 0.75),
    ("phq9_suicidal_ideation", "Suicidal ideation (Q9)", 1.5),
]

# --- Post cleaning patterns and weak labels (fixed values) ---
URL_PATTERN = r"http\S+|www\.\S+"
MENTION_PATTERN = r"/?[ru]/\w+"
SPACE_PATTERN = r"\s+"
REMOVED_MARKERS = ["[deleted]", "[removed]"]
DELETED_AUTHOR = "[deleted]"
SUBREDDIT_LABELS = {
    "depression": "depression", "depression_help": "depression", "anxiety": "anxiety",
    "Anxiety": "anxiety", "socialanxiety": "anxiety", "SuicideWatch": "suicidal_ideation",
    "mentalhealth": "general", "MentalHealthSupport": "general", "bipolar": "bipolar",
    "BPD": "bpd", "ptsd": "ptsd",
}
COHORT_COLUMNS = ["author", "subreddit", "label", "text", "created_utc", "split"]

# --- Symptom labels, subreddit symptoms and keywords (fixed values) ---
SYMPTOMS = ["depression", "anxiety", "suicidal_ideation", "substance_use", "insomnia",
            "anhedonia", "hopelessness"]
SUBREDDIT_SYMPTOMS = {
    "depression": ["depression", "anhedonia", "hopelessness"],
    "depression_help": ["depression", "hopelessness"],
    "anxiety": ["anxiety"],
    "Anxiety": ["anxiety"],
    "socialanxiety": ["anxiety"],
    "SuicideWatch": ["suicidal_ideation", "hopelessness"],
    "mentalhealth": ["depression"],
    "MentalHealthSupport": ["depression"],
    "bipolar": ["depression", "anhedonia"],
    "BPD": ["depression", "anxiety"],
    "ptsd": ["anxiety"],
}
SYMPTOM_KEYWORDS = {
    "suicidal_ideation": ["kill myself", "end my life", "want to die", "suicide", "suicidal",
                          "take my own life", "not want to live", "rather be dead"],
    "insomnia": ["can't sleep", "cannot sleep", "insomnia", "up all night", "no sleep",
                 "awake at", "3am", "4am"],
    "substance_use": ["drinking", "drunk", "alcohol", "weed", "marijuana", "drugs",
                      "high to cope", "self-medicate"],
    "anhedonia": ["nothing feels good", "can't enjoy", "lost interest", "no pleasure",
                  "things I used to love"],
    "hopelessness": ["no point", "pointless", "hopeless", "never get better", "no future",
                     "give up"],
}
RISK_KEYWORDS = ["kill myself", "end my life", "want to die", "suicidal", "not want to live",
                 "rather be dead", "wish I were dead"]
IDEATION_THRESHOLD = 0.40
SYMPTOM_THRESHOLD = 0.50

# --- Risk rules as (family, pattern) (fixed values) ---
RISK_RULES = [
    ("direct_intent", r"\bkill(?:ing)?\s+myself\b"),
    ("direct_intent", r"\bend\s+my\s+life\b"),
    ("direct_intent", r"\bwant(?:ed|ing)?\s+to\s+die\b"),
    ("direct_intent", r"\bnot\s+want\s+to\s+live\b"),
    ("first_person", r"\bI\s+(?:am|'m|feel|felt|am\s+feeling|was|have\s+been)\s+suicidal\b"),
    ("bare_noun", r"\bsuicide\b"),
    ("passive_wish", r"\brather\s+be\s+dead\b"),
    ("passive_wish", r"\bwish\s+I\s+were\s+dead\b"),
    ("direct_intent", r"\btake\s+my\s+own\s+life\b"),
    ("passive_wish", r"\bhoping\s+I\s+don.t\s+wake\b"),
    ("passive_wish", r"\bdon.t\s+want\s+to\s+wake\b"),
    ("passive_wish", r"\bwouldn.t\s+mind\s+dying\b"),
    ("passive_wish", r"\bno\s+reason\s+to\s+live\b"),
    ("passive_wish", r"\bbetter\s+off\s+dead\b"),
    ("burdensomeness", r"\bbetter\s+off\s+without\s+me\b"),
    ("burdensomeness", r"\bwithout\s+me\s+(?:here|around)\b"),
    ("passive_wish", r"\bgo\s+to\s+sleep\s+and\s+never\s+wake\b"),
    ("preparation", r"\bwriting\s+.*?letters?\b"),
    ("preparation", r"\bgiving\s+away\s+my\b"),
    ("funeral_imagery", r"\bmy\s+funeral\b"),
    ("funeral_imagery", r"\bimagining.*funeral\b"),
    ("means", r"\btake\s+all\s+my\s+(?:medication|pills?|tablets?|meds?)\b"),
    ("means", r"\boverdos(?:e|ing|ed)\b"),
    ("means", r"\bbought\s+a\s+rope\b"),
    ("means", r"\bhow\s+much\s+\S+\s+(?:it\s+)?would\s+take\b"),
    ("means", r"\bhow\s+much\s+\S+.*would.*take\b"),
]
REPORTED_SPEECH_FRAMES = [
    r"\bask(?:ed|ing)?\s+(?:me|him|her|them|us|you)?\s+(?:if|whether)\b",
    r"\bif\s+I\s+was\s+suicidal\b",
    r"\bif\s+I\s+(?:am|were|had\s+been)\s+suicidal\b",
    r"\bwondering\s+(?:if|whether)\b",
]

# --- Messages (fixed values) ---
ESCALATION_REASON = (
    "DETERMINISTIC ESCALATION: Suicidal ideation signal detected (PHQ-9 item 9 > 0, MentalBERT "
    "SI positive, or SI keyword in narrative). This verdict cannot be overridden. Refer "
    "immediately to crisis protocol."
)
REASON_VERDICT = "Safety verdict: "
REASON_FLAGS = "LLM verifier flags: "
REASON_NO_FLAGS = "LLM verifier: no issues found in the generated care plan."
SUGGESTION_PREFIX = "Consider:"
SUGGEST_SAFETY = (
    "Consider: Immediate safety assessment using Columbia Suicide Severity Rating Scale (C-SSRS). "
    "Determine plan, intent, and means access."
)
SUGGEST_REFERRAL = (
    "Consider: Referral for psychiatric evaluation and evidence-based therapy (CBT or IPT) per "
    "NICE Depression Guidelines (CG90)."
)
SUGGEST_ANXIETY = (
    "Consider: GAD management pathway — CBT, relaxation techniques, and evaluation for comorbid "
    "depression per NICE GAD Guideline (CG113)."
)
SUGGEST_FOLLOW_UP = (
    "Consider: Follow-up PHQ-9 reassessment in 2–4 weeks to monitor trajectory."
)
SUGGEST_ROUTINE = (
    "Consider: Routine monitoring with PHQ-9 at next appointment. Psychoeducation on depression "
    "and anxiety management strategies."
)
QUERY_DEPRESSION = "Major Depressive Disorder"
QUERY_MILD = "mild depression dysthymia"
QUERY_ANXIETY = "Generalised Anxiety Disorder"
QUERY_IDEATION = "suicidal ideation risk assessment escalation"
QUERY_DEFAULT = "depression anxiety mental health"
NO_INDEX_CONTEXT = "RAG index not available — run `make rag-index` first."
NO_HIT_ANSWER = (
    "I could not retrieve any relevant information from the indexed sources (DSM summaries and "
    "PubMed abstracts) for this query. Please consult a licensed psychiatrist and primary "
    "literature directly."
)
CONTEXT_SEPARATOR = "\n\n---\n\n"

# --- Input contract (fixed values) ---
PLACEHOLDER_NARRATIVES = ["test", "n/a", "none", ""]
AGE_RANGE = (18, 100)
NARRATIVE_MAX = 4000
GENDER_MAX = 20

# --- Model inputs (fixed values) ---
DERIVED_FEATURES = ["somatic_cluster", "cognitive_cluster", "gad_physical_cluster", "si_flag",
                    "phq_gad_ratio"]
NUMERIC_FEATURES = PHQ_ITEMS + GAD_ITEMS + ["age", "phq9_total", "gad7_total"]
BINARY_FEATURES = ["prior_diagnosis", "on_medication"]
CATEGORICAL_FEATURES = ["gender", "education"]
DRIFT_NUMERIC = PHQ_ITEMS + GAD_ITEMS + ["phq9_total", "gad7_total", "age"]
DRIFT_CATEGORICAL = ["gender", "phq9_band"]

# --- Audit log defaults in record order (fixed values) ---
AUDIT_DEFAULTS = {
    **{item: 0 for item in ALL_ITEMS},
    "age": 0, "gender": "unknown", "phq9_total": 0, "gad7_total": 0, "phq9_band": "none",
    "severity_score": 0.0, "suicidal_ideation_prob": 0.0, "safety_verdict": "routine",
    "deterministic_escalation": False,
}

# --- Population table profile (fixed values) ---
PHQ_CUTS = [[0.6, 1.6, 2.7], [0.5, 1.5, 2.6], [0.7, 1.7, 2.8], [0.8, 1.8, 2.9], [1.0, 2.0, 3.0],
            [1.4, 2.3, 3.1], [1.5, 2.4, 3.2], [1.7, 2.6, 3.4], [2.3, 3.1, 3.8]]
GAD_CUTS = [[-0.3, 0.7, 1.8], [-0.1, 0.9, 2.0], [0.0, 1.0, 2.1], [0.2, 1.2, 2.2],
            [0.3, 1.3, 2.3], [0.4, 1.4, 2.3], [0.5, 1.5, 2.4]]
ITEM_NOISE_SD = 0.6
POPULATION = {
    "age": (18, 79),
    "gender": [("female", 0.51), ("male", 0.48), ("nonbinary", 0.01)],
    "education": [("primary", 0.15), ("secondary", 0.40), ("undergrad", 0.35), ("postgrad", 0.10)],
    "diagnosis": 0.12, "medication": 0.55, "shift_diagnosis": 0.9, "shift_young": 0.15,
    "shift_female": 0.10, "anxiety_link": 0.65,
}

# --- Clinical table profile (fixed values) ---
CLINICAL = {
    "age": (18, 80),
    "gender": [("female", 0.48), ("male", 0.45), ("non-binary", 0.04),
               ("prefer_not_to_say", 0.03)],
    "education": [("secondary", 0.35), ("undergraduate", 0.40), ("postgraduate", 0.18),
                  ("no_formal", 0.07)],
    "diagnosis": 0.28, "medication": 0.55,
    "group_weights": [0.40, 0.25, 0.20, 0.10, 0.05],
    "group_means": [2.0, 7.0, 12.0, 17.0, 23.0],
    "group_sds": [1.5, 2.0, 2.0, 2.0, 2.0],
    "anxiety_link": 0.6, "anxiety_sd": 3.0,
    "ideation_high": 0.45, "ideation_high_levels": [(1, 0.5), (2, 0.3), (3, 0.2)],
    "ideation_moderate": 0.12,
    "split": [("train", 0.70), ("val", 0.15), ("test", 0.15)],
}

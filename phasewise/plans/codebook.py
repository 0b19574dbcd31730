"""Code lists, level sets, labels and weights of the study's instruments.

Fixed values: everything in this file states answers, labels or published scoring constants
that results must carry word for word.  All functions take such tables as parameters; these
are the defaults.
"""

# ---- column name spellings in the demographics exports -------------------------------

COLUMN_SPELLINGS = [
    (r"diganosed", "diagnosed"),
    (r"type_participant", "category_participant"),
    (r"^(dhl_|dhls_?)", "dhls_"),
    (r"_bl$", ""),
]

# ---- coded answers -------------------------------------------------------------------

CATEGORICAL = {
    "study_completion": {
        1: "Currently enrolled",
        2: "Completed study",
        3: "Withdrawn",
        4: "Ineligible",
    },
    "gender": {1: "Male", 2: "Female", 3: "Non-binary"},
    "hispanic": {0: "Non-Hispanic", 1: "Hispanic"},
    "marital": {1: "Married", 2: "Divorced/separated", 3: "Widowed", 4: "Never married"},
    "employment": {
        1: "Working full time",
        2: "Working part time",
        3: "Full time student",
        4: "Not employed",
        5: "Retired",
        6: "Other",
    },
    "education": {
        1: "Less than a high school diploma",
        2: "High school diploma or equivalent",
        3: "Some college, no degree",
        4: "Associate of arts of other 2-year degree",
        5: "Bachelor's degree",
        6: "Graduate degree",
    },
    "mentaldx": {1: "Yes, current", 2: "Yes, past", 3: "No"},
    "cancer_status": {1: "Stable", 2: "Progressing", 3: "In remission", 4: "Not sure"},
    "cancer_category_participant": {
        1: "Prostate",
        2: "Colon",
        3: "Lung",
        4: "Pancreatic",
        5: "Other",
    },
}

MULTIPLE_CHOICE = {
    "race": {
        1: "White/Caucasian",
        2: "Black/African American",
        3: "American Indian or Alaska Native",
        4: "Asian",
        5: "Native Hawaiian or Other Pacific Islander",
        6: "Other",
    },
    "living": {1: "Alone", 2: "Partner", 3: "Children", 4: "Other"},
    "cancer_treatment": {
        1: "Surgery",
        2: "Chemotherapy",
        3: "Radiation",
        4: "Immunotherapy",
        5: "Hormone therapy",
        6: "Other",
    },
}

DATE_SUFFIXES = ["diagnosed", "diagnosed_stage4", "treatment"]

# start, end, units
INTERVALS = [
    ("date_diagnosed", "demo_datetime", "months"),
    ("date_diagnosed_stage4", "demo_datetime", "months"),
    ("date_treatment", "demo_datetime", "days"),
]

# ---- level sets of the characteristics table -----------------------------------------

LEVELS = {
    "cohort": ["Phase 0", "Phase 1"],
    "gender": ["Female", "Male"],
    "race": [
        "White/Caucasian",
        "Black/African American",
        "White/Caucasian & Black/African American",
    ],
    "marital": ["Married", "Divorced/separated", "Widowed", "Never married"],
    "living": ["Alone", "With children", "With partner", "With partner & children", "Other"],
    "employment": ["Working full time", "Working part time", "Not employed", "Retired", "Other"],
    "education": [
        "High school diploma or equivalent",
        "Some college, no degree",
        "Associate of arts of other 2-year degree",
        "Bachelor's degree",
        "Graduate degree",
    ],
    "cancer_category_participant": ["Colon", "Lung", "Pancreatic", "Prostate", "Other"],
    "cancer_status": ["Stable", "Progressing", "In remission", "Not sure"],
}
COHORT_NAMES = {"phase0": "Phase 0", "phase1": "Phase 1"}

CHARACTERISTIC_LABELS = {
    "age": "Age, years",
    "gender": "Gender",
    "race": "Race",
    "marital": "Marital status",
    "living": "Living situation",
    "employment": "Employment situation",
    "education": "Education",
    "cancer_category_participant": "Cancer type",
    "cancer_status": "Cancer status",
    "months_since_diagnosed_at_demo_datetime": "Time since cancer diagnosis, months",
    "months_since_diagnosed_stage4_at_demo_datetime": "Time since stage IV diagnosis, months",
    "days_since_treatment_at_demo_datetime": "Time since most recent treatment, days",
    "dhls_score": "Digital Health Literacy Scale (DHLS) score",
}
TREATMENT_HEADER = "Cancer treatment"

# ---- questionnaire scoring -----------------------------------------------------------

T_MEAN, T_SD = 50, 10
PAIN_MEAN, PAIN_SD = 2.31, 2.34

# domain, physical weight, mental weight
SUMMARY_WEIGHTS = [
    ("pf", 0.872, -0.015),
    ("paincomposite", -0.094, -0.154),
    ("social", 0.113, 0.252),
    ("fatigue", -0.009, -0.351),
    ("emotcomposite", 0.003, -0.257),
    ("sleep", 0.002, -0.139),
]

# ---- display names of outcomes -------------------------------------------------------

ANOVA_NAMES = [
    ("^cesd", "CESD Score"),
    ("^peat", "PEAT Score"),
    ("^sip", "SIP Score"),
    ("promis_anx", "Anxiety"),
    ("promis_cf", "Cognitive function"),
    ("promis_dep", "Depression"),
    ("promis_fat", "Fatigue"),
    ("promis_pain", "Pain interference"),
    ("promis_pf", "Physical function"),
    ("promis_sleep", "Sleep disturbance"),
    ("promis_social", "Social roles and activities"),
    ("physical_health", "Summary Physical health"),
    ("mental_health", "Summary Mental health"),
]
ANOVA_SUBSCALE_HEADER = "PROMIS Subscale t-score"
ANOVA_SUMMARY_HEADER = "PROMIS Summary t-score"

TTEST_NAMES = [("goodness", "Goodness score"), ("sumsteps", "Step count")]
TTEST_STATS = [("mean$", "mean"), ("n$", "n")]

# ---- feedback and compliance tables --------------------------------------------------

PHASE0_FEEDBACK_LABELS = {
    "app_difficulty_num": "How **easy** was it to use the study application?",
    "app_pleasantness_num": "How **pleasant** was it to use the study application?",
    "app_burden_num": "How **burdensome** was it to use the study application?",
    "willingness_participate_num": (
        "How likely would you be to **participate** in this study or use this app?"
    ),
    "willingness_recommend_num": (
        "How likely would you be to **recommend** this study or app to a friend with advanced"
        " cancer?"
    ),
}

PHASE1_FEEDBACK_LABELS = {
    "sus_score_eos": "System Usability Scale (SUS) Score",
    "app_interest_self": "Keep using the study app on your own",
    "app_interest_score_friend": "Recommend the study app to a friend with cancer",
    "study_value_score_phase1evening": "Nightly surveys during Phase 1",
    "study_value_score_calendar": "Calendar visualizations in the app",
    "study_value_score_report": "Mid-study data report",
    "study_value_score_review": "Mid-study data review meeting",
    "study_value_score_phase2morning": (
        "Selecting the activities you want to perform each morning of Phase 2"
    ),
    "study_value_score_phase2evening": "Nightly check-ins during Phase 2",
    "data_sharing_providers_score": "Sharing any of the data you collected with your care team",
    "data_sharing_others_score": (
        "Did you ever share any of the data you collected during this study with anyone else?"
    ),
}

# variable the header precedes, header
PHASE1_FEEDBACK_HEADERS = [
    ("app_interest", "On a scale of 0 to 10, how likely would you be to:"),
    (
        "study_value",
        "On a scale of 0 to 10, how valuable did you find the following aspects of the study:",
    ),
    ("data_sharing_providers", "On a scale of 0 to 10, how interested would you be in:"),
]

SURVEY_COMPLIANCE_HEADERS = [
    ("rate_expected", "Percent of expected surveys completed"),
    ("rate_days", "Percent of days with completed survey(s)"),
]
SURVEY_RATE_LABELS = {
    "rate_expected_surveys_completed_overall": "Overall",
    "rate_expected_surveys_completed_phase1": "Phase 1",
    "rate_expected_surveys_completed_phase2": "Phase 2",
    "rate_days_with_surveys_overall_any": "Overall, any",
    "rate_days_with_surveys_overall_all": "Overall, all",
    "rate_days_with_surveys_phase1_daily": "Phase 1, daily",
    "rate_days_with_surveys_phase2_morning": "Phase 2, morning",
    "rate_days_with_surveys_phase2_evening": "Phase 2, evening",
    "rate_days_with_surveys_phase2_morning_or_evening": "Phase 2, morning or evening",
    "rate_days_with_surveys_phase2_morning_and_evening": "Phase 2, morning and evening",
}
DEVICE_COMPLIANCE_HEADER = "Percent of days with sufficient Fitbit data"

ENGAGEMENT_LABELS = {
    "selected_phase1_all": "Selected activities, n",
    "selected_phase1_custom": "Custom selected activities, n",
    "selected_phase1_custom_prop": "Custom selected activities, %",
    "phase1_total_endorsed": "Total endorsed activities, n",
    "phase1_unique_endorsed": "Unique endorsed activities, n",
    "phase1_total_rated": "Total rated activities, n",
    "phase1_endorsed_activity_rating_rate_mean": "Daily endorsed activity rating rate, mean %",
    "phase1_activity_rating_mean": "Activity rating, mean",
    "selected_phase2_all": "Selected activities, n",
    "selected_phase2_custom": "Custom selected activities, n",
    "selected_phase2_custom_prop": "Custom selected activities, %",
    "selected_phase2_not_phase1_all": "Newly added activities, n",
    "selected_phase2_not_phase1_all_prop": "Newly added activities, %",
    "phase2_total_planned": "Total planned activities, n",
    "phase2_total_completed": "Total completed activities, n",
    "phase2_total_planned_and_completed": "Total planned and completed activities, n",
    "phase2_unique_planned_and_completed": "Unique planned and completed activities, n",
    "phase2_planned_activity_completion_rate_mean": (
        "Daily planned activity completion rate, mean %"
    ),
}
ENGAGEMENT_HEADERS = [
    ("selected_phase1_all", ["Phase 1", "\tActivity selection"]),
    ("phase1_total_endorsed", ["\tActivity endorsement and rating"]),
    ("selected_phase2_all", ["Phase 2", "\tActivity selection"]),
    ("phase2_total_planned", ["\tActivity planning and completion"]),
]

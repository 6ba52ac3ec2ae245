"""Names, code ranges and label tables of the hospital-encounter layout.

They must equal the published ones for equal results. Operators never import this module; only
``plans.stages`` passes these values to them.
"""

# The 23 drug columns.
MEDICATION_COLUMNS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride", "acetohexamide",
    "glipizide", "glyburide", "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose", "miglitol",
    "troglitazone", "tolazamide", "examide", "citoglipton", "insulin", "glyburide-metformin",
    "glipizide-metformin", "glimepiride-pioglitazone", "metformin-rosiglitazone", "metformin-pioglitazone",
]

# Numeric measures.
NUMERIC_COLUMNS = [
    "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
]

# Identifiers, columns always dropped, leaky ratios.
ID_COLUMNS = ["encounter_id", "patient_nbr"]
DROPPED_COLUMNS = [
    "weight", "payer_code", "encounter_id", "patient_nbr", "medical_specialty", "max_glu_serum", "A1Cresult",
]
LEAKY_COLUMNS = ["lab_per_day", "meds_per_day", "procedures_per_day"]

# Discharge ids of persons who died or went to hospice.
EXCLUDED_DISCHARGE_IDS = [11, 13, 14, 19, 20, 21]

# Text cells a CSV reader of data frames treats as missing, plus the data set's own marker.
MISSING_MARKERS = [
    "?", "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Ordered age bands.
AGE_BANDS = [
    "[0-10)", "[10-20)", "[20-30)", "[30-40)", "[40-50)",
    "[50-60)", "[60-70)", "[70-80)", "[80-90)", "[90-100)",
]

# Diagnosis chapters as closed code ranges; the half-open first range wins.
CODE_FIRST = ("Diabetes", 250, 251)
CODE_RANGES = [
    ("Infectious", 1, 139), ("Neoplasms", 140, 239), ("Endocrine_Metabolic", 240, 279), ("Blood", 280, 289),
    ("Mental", 290, 319), ("Nervous_System", 320, 389), ("Circulatory", 390, 459), ("Respiratory", 460, 519),
    ("Digestive", 520, 579), ("Genitourinary", 580, 629), ("Pregnancy", 630, 679), ("Skin", 680, 709),
    ("Musculoskeletal", 710, 739), ("Congenital", 740, 759), ("Perinatal", 760, 779), ("Symptoms", 780, 799),
    ("Injury_Poisoning", 800, 999),
]
CODE_PREFIXES = {"V": "Supplementary", "E": "External_Causes"}

# Labels of the three id columns.
ADMISSION_TYPES = {
    1: "Emergency", 2: "Urgent", 3: "Elective", 4: "Newborn", 5: "Not_Available", 6: "NULL",
    7: "Trauma_Center", 8: "Not_Mapped",
}
DISCHARGE_DISPOSITIONS = {
    1: "Home", 2: "Short_Term_Hospital", 3: "Skilled_Nursing", 4: "Intermediate_Care", 5: "Other_Inpatient",
    6: "Home_Health_Org", 7: "AMA", 8: "Home_IV", 9: "Admitted_Inpatient", 10: "Neonate", 11: "Expired",
    12: "Still_Patient", 13: "Hospice_Facility", 14: "Hospice_Home", 15: "Swing_Bed", 16: "Rehab_Facility",
    17: "Long_Term_Hospital", 18: "Not_Applicable", 19: "Expired_Medicaid_Home",
    20: "Expired_Medicaid_Facility", 21: "Expired_Unknown", 22: "Short_Term_Rehab", 23: "Long_Term_Rehab",
    24: "Nursing_Facility", 25: "Psychiatric_Hospital", 27: "Federal_Health_Facility", 28: "Veteran_Hospital",
}
ADMISSION_SOURCES = {
    1: "Physician_Referral", 2: "Clinic_Referral", 3: "HMO_Referral", 4: "Transfer_Hospital",
    5: "Transfer_SNF", 6: "Transfer_Other", 7: "Emergency_Room", 8: "Court_Law", 9: "Not_Available",
    10: "Transfer_Critical_Access", 11: "Normal_Delivery", 12: "Premature_Delivery", 13: "Sick_Baby",
    14: "Extramural_Birth", 15: "Not_Available_15", 17: "NULL", 18: "Transfer_Acute", 19: "Not_Mapped",
    20: "Unknown", 21: "Readmission", 22: "Physician_Ext", 23: "Transfer_Outpatient", 24: "Transfer_SNF_24",
    25: "Transfer_Rehab",
}

# Integer columns of the raw table; every other column is text. Order of the raw file.
RAW_INTEGER_COLUMNS = [*ID_COLUMNS, "admission_type_id", "discharge_disposition_id", "admission_source_id", *NUMERIC_COLUMNS]
RAW_COLUMNS = [
    "encounter_id", "patient_nbr", "race", "gender", "age", "weight", "admission_type_id", "discharge_disposition_id",
    "admission_source_id", "time_in_hospital", "payer_code", "medical_specialty", "num_lab_procedures", "num_procedures",
    "num_medications", "number_outpatient", "number_emergency", "number_inpatient", "diag_1", "diag_2", "diag_3",
    "number_diagnoses", "max_glu_serum", "A1Cresult", "metformin", "repaglinide", "nateglinide", "chlorpropamide",
    "glimepiride", "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose",
    "miglitol", "troglitazone", "tolazamide", "examide", "citoglipton", "insulin", "glyburide-metformin",
    "glipizide-metformin", "glimepiride-pioglitazone", "metformin-rosiglitazone", "metformin-pioglitazone", "change",
    "diabetesMed", "readmitted",
]

# Columns of the categorical report, of the clustering and of the cluster profiles.
CATEGORICAL_COLUMNS = [
    "race", "gender", "age", "payer_code", "medical_specialty", "max_glu_serum", "A1Cresult", "change", "diabetesMed",
    "admission_type_id", "discharge_disposition_id", "admission_source_id",
]
CLUSTER_COLUMNS = [
    *NUMERIC_COLUMNS, "age_num", "n_active_meds", "total_visits", "change", "diabetesMed", "procedures_per_day", "meds_per_day",
]
PROFILE_COLUMNS = [*NUMERIC_COLUMNS, "age_num", "n_active_meds", "early_readmit"]

# Names under which results of the experiments were published, by the names used here.
PUBLISHED_CLASSIFIERS = {
    "nearest_5_all": "EXP01_KNN_k5_all_features",
    "nearest_11_top20": "EXP02_KNN_k11_top20_anova",
    "naive_bayes": "EXP03_NaiveBayes_GaussianNB",
    "tree_depth5": "EXP04_DecisionTree_depth5",
    "tree_depth10_leaf20": "EXP05_DecisionTree_depth10_min20",
    "forest_100_balanced": "EXP06_RandomForest_n100_balanced",
    "forest_200_tuned_balanced": "EXP07_RandomForest_n200_tuned_balanced",
    "boosted_100": "EXP08_XGBoost_n100",
    "calibrated_svm_top20": "EXP09_LinearSVM_top20",
    "perceptron_top30": "EXP10_MLP_2layer_top30",
}
PUBLISHED_REGRESSORS = {
    "least_squares_all": "EXP01_LinearRegression_all",
    "ridge_1_all": "EXP02_Ridge_a1_all",
    "ridge_10_top20": "EXP03_Ridge_a10_top20",
    "lasso_001_all": "EXP04_Lasso_a001_all",
    "tree_depth5": "EXP05_DecisionTree_depth5",
    "tree_depth10_leaf20": "EXP06_DecisionTree_depth10_min20",
    "forest_100": "EXP07_RandomForest_n100",
    "boosted_100": "EXP08_XGBoost_n100",
    "boosted_100_without_family": "EXP09_XGBoost_NoLeak",
    "poisson_1_all": "EXP10_Poisson_all",
}

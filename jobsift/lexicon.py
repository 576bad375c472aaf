"""Default lexicon of the French data-science job market.

FIXED VALUES: the lists and maps below must equal the ones the cleaning and
reporting rules were defined with, so results match. They are stated as plain
text, in their natural order. Every function that uses them takes the list as
an argument, with these only as defaults.
"""

# --- FIXED VALUES: target schema column order -------------------------------
TARGET_COLUMNS = [
    "title", "company", "city", "contract_type", "salary_min",
    "salary_max", "salary_avg", "currency", "description",
    "category", "published_at", "url", "source", "tech_stack",
    "collected_at",
]

# --- FIXED VALUES: raw-column -> target-column maps per source ---------------
# (several raw names may map to one target: they are coalesced in this order)
API_COLUMN_MAP = {
    "title": "title",
    "company.display_name": "company",
    "location.display_name": "city",
    "contract_type": "contract_type",
    "contract_time": "contract_time",
    "salary_min": "salary_min",
    "salary_max": "salary_max",
    "description": "description",
    "category.label": "category",
    "created": "published_at",
    "redirect_url": "url",
    "id": "source_id",
}

THIRD_SOURCE_COLUMN_MAP = {
    "title": "title",
    "job_title": "title",
    "titre_poste": "title",
    "company_name": "company",
    "entreprise": "company",
    "organization.name": "company",
    "location": "city",
    "ville": "city",
    "office.city": "city",
    "contract_type": "contract_type",
    "type_contrat": "contract_type",
    "salary": "salary_raw",
    "salaire": "salary_raw",
    "description": "description",
    "published_at": "published_at",
    "date_publication": "published_at",
    "url": "url",
    "link": "url",
}

SCRAPED_COLUMN_MAP = {
    "title": "title",
    "company": "company",
    "location": "city",
    "contract_type": "contract_type",
    "salary": "salary_raw",
    "description": "description",
    "url": "url",
    "remote": "remote",
}

# --- FIXED VALUES: exploration (notebook) column names ----------------------
EXPLORE_API_RENAME = {
    "title": "intitule_poste",
    "description": "description",
    "company.display_name": "entreprise",
    "location.display_name": "ville",
    "location.area": "region_list",
    "category.label": "categorie",
    "contract_type": "type_contrat",
    "contract_time": "temps_contrat",
    "salary_min": "salaire_min",
    "salary_max": "salaire_max",
    "created": "date_publication",
    "redirect_url": "url",
    "latitude": "latitude",
    "longitude": "longitude",
    "id": "id_offre",
    "_source": "source",
    "_fetched_at": "date_collecte",
}

EXPLORE_THIRD_RENAME = {
    "title": "intitule_poste",
    "company_name": "entreprise",
    "location": "ville",
    "description": "description",
    "contract_type": "type_contrat",
    "salary": "salaire_brut",
    "published_at": "date_publication",
    "url": "url",
    "_source": "source",
}

EXPLORE_EXPORT_COLUMNS = [
    "intitule_poste", "entreprise", "ville", "type_contrat",
    "salaire_min", "salaire_max", "salaire_moyen",
    "description", "categorie", "date_publication", "source", "url",
]

# --- FIXED VALUES: skills searched in descriptions (cleaning) ---------------
TECH_SKILLS = [
    "Python", "SQL", "R", "Scala", "Java", "Julia", "Go",
    "Spark", "PySpark", "Hadoop", "Hive", "Kafka", "Flink",
    "TensorFlow", "PyTorch", "Scikit-Learn", "Keras", "XGBoost", "LightGBM",
    "AWS", "Azure", "GCP", "Google Cloud",
    "Docker", "Kubernetes", "Airflow", "dbt", "MLflow", "Kubeflow",
    "Tableau", "Power BI", "Looker", "Metabase",
    "Snowflake", "BigQuery", "Redshift", "Databricks",
    "MongoDB", "PostgreSQL", "MySQL", "Elasticsearch", "Redis",
    "FastAPI", "Flask", "Django",
    "Git", "Terraform", "CI/CD", "Linux",
    "Deep Learning", "Machine Learning", "NLP", "Computer Vision",
    "Pandas", "NumPy", "SciPy",
]

# --- FIXED VALUES: skills searched by the exploratory analysis --------------
EXPLORE_SKILLS = [
    "Python", "SQL", "R", "Scala", "Java", "Julia",
    "Spark", "PySpark", "Hadoop", "Hive", "Kafka",
    "TensorFlow", "PyTorch", "Scikit-Learn", "Keras", "XGBoost",
    "Pandas", "NumPy", "SciPy",
    "AWS", "Azure", "GCP", "Google Cloud",
    "Docker", "Kubernetes", "Airflow", "dbt", "MLflow",
    "Tableau", "Power BI", "Looker", "Excel",
    "Git", "CI/CD", "Terraform", "Linux",
    "Deep Learning", "Machine Learning", "NLP", "Computer Vision",
    "ETL", "Data Warehouse", "Snowflake", "BigQuery", "Redshift",
    "MongoDB", "PostgreSQL", "MySQL", "Elasticsearch",
    "API", "REST", "FastAPI", "Flask", "Django",
    "Agile", "Scrum",
]

# --- FIXED VALUES: keyword families of the skills report --------------------
CLOUD_KEYWORDS = ["aws", "azure", "gcp", "google cloud"]

GENAI_KEYWORDS = ["llm", "langchain", "rag", "gpt", "openai", "chatgpt",
                  "generative ai", "ia générative", "prompt engineering",
                  "transformer", "hugging face", "huggingface", "fine-tuning",
                  "vector database", "embedding"]

TRADITIONAL_KEYWORDS = ["hadoop", "spark", "pyspark", "hive", "mapreduce",
                        "pig", "sqoop", "hdfs", "oozie", "presto"]

SOFT_SKILLS = ["gestion de projet", "management", "agilité", "agile", "scrum",
               "communication", "leadership", "teamwork", "travail d'équipe",
               "présentation", "autonomie", "rigueur", "organisation",
               "esprit d'équipe", "reporting", "coordination"]

HARD_SKILLS = ["python", "sql", "r", "scala", "java", "spark", "tensorflow",
               "pytorch", "scikit-learn", "docker", "kubernetes", "airflow",
               "aws", "azure", "gcp", "tableau", "power bi", "git",
               "machine learning", "deep learning", "nlp", "pandas",
               "snowflake", "bigquery", "databricks", "kafka", "dbt"]

CLOUD_PROVIDERS = {
    "AWS": ["aws", "amazon web services", "s3", "lambda", "ec2"],
    "Azure": ["azure", "microsoft azure"],
    "GCP": ["gcp", "google cloud", "bigquery"],
}

PREMIUM_FALLBACK_SKILLS = ["Python", "R", "SQL", "Machine Learning", "Docker",
                           "AWS", "Java", "Kubernetes", "CI/CD", "Power BI"]

# --- FIXED VALUES: work-mode patterns, first match wins (case-insensitive) --
WORK_MODE_PATTERNS = [
    ("Full Remote",
     r"full\s*remote|100\s*%?\s*remote|télétravail\s*complet|fully\s*remote"),
    ("Hybride",
     r"hybride|hybrid|télétravail\s*partiel|remote\s*partiel|\d+\s*j(?:ours?)?\s*/?\s*semaine"),
    ("Présentiel",
     r"présentiel|sur\s*site|on[\s-]?site|pas\s*de\s*télétravail|no\s*remote"),
]
WORK_MODE_UNKNOWN = "Non précisé"

# --- FIXED VALUES: contract maps --------------------------------------------
CONTRACT_MAP = {
    "permanent": "CDI", "cdi": "CDI", "full_time": "CDI",
    "contract": "CDD", "cdd": "CDD", "temporary": "CDD",
    "freelance": "Freelance", "independent": "Freelance",
    "internship": "Stage", "stage": "Stage", "intern": "Stage",
    "apprenticeship": "Alternance", "alternance": "Alternance",
    "part_time": "Temps partiel",
}

EXPLORE_CONTRACT_MAP = {
    "permanent": "CDI", "cdi": "CDI", "full_time": "CDI",
    "contract": "CDD", "cdd": "CDD",
    "freelance": "Freelance", "independent": "Freelance",
    "internship": "Stage", "stage": "Stage",
    "apprenticeship": "Alternance", "alternance": "Alternance",
    "part_time": "Temps partiel",
}

# exact key first, then the first key (in this order) contained in the value
CONTRACT_LABEL_MAP = {
    "cdi": "CDI", "contrat à durée indéterminée": "CDI",
    "cdd": "CDD", "contrat à durée déterminée": "CDD",
    "stage": "Stage", "internship": "Stage",
    "alternance": "Alternance", "apprentissage": "Alternance",
    "freelance": "Freelance", "indépendant": "Freelance",
    "interim": "Intérim", "intérim": "Intérim",
    "non précisé": "Non précisé", "": "Non précisé",
}

# substring rules, first hit wins; anything else is "Autre"
CONTRACT_SUBSTRING_RULES = [
    ("CDI", ["cdi"]),
    ("CDD", ["cdd"]),
    ("Freelance", ["freelance", "indépendant"]),
    ("Stage", ["stage"]),
    ("Alternance", ["alternance", "apprentissage"]),
    ("Intérim", ["intérim", "interim"]),
]
CONTRACT_OTHER = "Autre"

STAGE_WORDS = ["stage", "stagiaire", "internship", "intern"]
ALTERNANCE_WORDS = ["alternance", "alternant", "apprenti", "apprentissage", "apprentice"]

# --- FIXED VALUES: places ---------------------------------------------------
PLACE_UNKNOWN = "Non precise"
CITY_CLEAN_UNKNOWN = "Non précisé"

PLACE_JUNK_FRAGMENTS = ["{", "}", "Props", "Authenticated", "@Context", "Schema.Org",
                        "Http", "<", ">", "\\"]

CITY_ALIASES = {
    "Paris, France": "Paris",
    "Ile-De-France": "Paris",
    "Ile De France": "Paris",
    "France": "Non precise",
    "Haute-Garonne, Occitanie": "Toulouse",
    "Nord, Hauts-De-France": "Lille",
    "Rhône, Auvergne-Rhône-Alpes": "Lyon",
    "Bouches-Du-Rhône, Provence-Alpes-Côte D'Azur": "Marseille",
    "Hauts-De-Seine, Ile-De-France": "Paris",
    "Gironde, Nouvelle-Aquitaine": "Bordeaux",
    "Loire-Atlantique, Pays De La Loire": "Nantes",
    "Bas-Rhin, Grand Est": "Strasbourg",
    "Hérault, Occitanie": "Montpellier",
    "Ille-Et-Vilaine, Bretagne": "Rennes",
    "Isère, Auvergne-Rhône-Alpes": "Grenoble",
    "Alpes-Maritimes, Provence-Alpes-Côte D'Azur": "Nice",
}

EXPLORE_CITY_ALIASES = {
    "Paris, France": "Paris",
    "Ile-De-France": "Paris",
    "Île-De-France": "Paris",
}

PARIS_DISTRICT_PATTERN = r"^\d+(Er|Ème|E)\s+Arrondissement,?\s*Paris"

CITY_COORDS = {
    "Paris": (48.8566, 2.3522),
    "Lyon": (45.7640, 4.8357),
    "Marseille": (43.2965, 5.3698),
    "Toulouse": (43.6047, 1.4442),
    "Bordeaux": (44.8378, -0.5792),
    "Nantes": (47.2184, -1.5536),
    "Lille": (50.6292, 3.0573),
    "Strasbourg": (48.5734, 7.7521),
    "Montpellier": (43.6108, 3.8767),
    "Nice": (43.7102, 7.2620),
    "Rennes": (48.1173, -1.6778),
    "Grenoble": (45.1885, 5.7245),
    "Aix-En-Provence": (43.5297, 5.4474),
    "Rouen": (49.4432, 1.0993),
    "Nanterre": (48.8924, 2.2071),
    "Boulogne-Billancourt": (48.8397, 2.2399),
    "La Defense": (48.8918, 2.2382),
    "Levallois-Perret": (48.8938, 2.2882),
    "Issy-Les-Moulineaux": (48.8244, 2.2700),
    "Clermont-Ferrand": (45.7772, 3.0870),
    "Angers": (47.4784, -0.5632),
    "Tours": (47.3941, 0.6848),
    "Dijon": (47.3220, 5.0415),
    "Saint-Etienne": (45.4397, 4.3872),
    "Metz": (49.1193, 6.1757),
    "Nancy": (48.6921, 6.1844),
    "Sophia-Antipolis": (43.6163, 7.0553),
    "Suresnes": (48.8694, 2.2291),
}

CITY_POPULATION = {
    "Paris": 2_161_000, "Lyon": 522_969, "Marseille": 873_076,
    "Toulouse": 498_003, "Bordeaux": 260_958, "Nantes": 320_732,
    "Lille": 236_234, "Strasbourg": 287_228, "Montpellier": 299_096,
    "Nice": 342_669, "Rennes": 222_485, "Grenoble": 158_198,
    "Aix-En-Provence": 147_122, "Rouen": 114_007, "Nanterre": 96_855,
    "Boulogne-Billancourt": 121_334, "La Defense": 20_000,
    "Levallois-Perret": 66_082, "Issy-Les-Moulineaux": 69_056,
    "Clermont-Ferrand": 147_865, "Angers": 157_175, "Tours": 138_588,
    "Dijon": 160_106, "Saint-Etienne": 177_480, "Metz": 120_205,
    "Nancy": 104_885, "Sophia-Antipolis": 10_000, "Suresnes": 49_833,
}

# --- FIXED VALUES: calendar labels and freshness buckets --------------------
WEEKDAY_FR = ["Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"]

AGE_BUCKET_EDGES = [0, 1, 3, 7, 14, 30, 999]
AGE_BUCKET_LABELS = ["< 1j", "1-3j", "3-7j", "7-14j", "14-30j", "> 30j"]

# --- FIXED VALUES: quality report fields ------------------------------------
QUALITY_FIELDS = ["title", "company", "city", "contract_type", "salary_avg",
                  "description", "tech_stack", "published_at"]

COMPLETENESS_FIELDS = {
    "Titre": "title", "Entreprise": "company", "Ville": "city",
    "Type contrat": "contract_type", "Salaire": "salary_avg",
    "Description": "description", "Tech Stack": "tech_stack",
    "Date publication": "published_at", "URL": "url", "Source": "source",
}

MISSING_FIELDS = ["title", "company", "city", "contract_type", "salary_avg",
                  "salary_min", "salary_max", "description", "tech_stack",
                  "published_at", "url", "source"]

# --- FIXED VALUES: numeric rules --------------------------------------------
SALARY_OUTLIER_LOW = 1000          # cleaning: kept if LOW < mean < HIGH
SALARY_OUTLIER_HIGH = 500000
EXPLORE_SALARY_LOW = 1000          # exploration: nulled if < LOW or > HIGH
EXPLORE_SALARY_HIGH = 200000
SPARSE_COLUMN_THRESHOLD = 0.7
CONTRACT_SHARE_MIN = 0.02
DESCRIPTION_MAX_CHARS = 5000
QUALITY_TITLE_CHARS = 40

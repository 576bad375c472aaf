"""Column -> Column functions (no Python UDFs)."""
from jobsift.functions.contract import (contract_label_exact, contract_label_substr, infer_contract,
                                        normalize_contract)
from jobsift.functions.place import city_clean, is_junk_place, normalize_city, normalize_city_explore
from jobsift.functions.salary import (detect_currency, parse_salary, row_mean, salary_avg, salary_avg_explore,
                                      salary_numbers, to_cents)
from jobsift.functions.text import (dedup_key_part, detect_work_mode, extract_skills, extract_skills_text,
                                    has_any_keyword, has_word, is_filled, keyword_pattern, norm_key, split_skills,
                                    text_blob, title_case, truncate_text, work_mode_text)
from jobsift.functions.time import (COMMON_DATE_FORMATS, WEEKDAY_EN, age_bucket, age_days, age_micros, age_whole_days, as_of_literal, normalize_date,
                                    publication_date, publication_hour, publication_month, publication_weekday,
                                    weekday_label_fr)

__all__ = [n for n in dir() if not n.startswith("_")]

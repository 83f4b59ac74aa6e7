"""Census header mapping for the wide-header clean-up (silver census)."""

from __future__ import annotations

GEOGRAPHY_ID_HEADER = "Geography"
AREA_NAME_HEADER = "Geographic Area Name"

# The survey year is read from the first header that looks like "<4 digits> Estimate...".
YEAR_HEADER_PATTERN = r"^[0-9]{4}"
ESTIMATE_MARKER = "Estimate"

# The census headers (text after "<year> Estimate!!"), the output
# column names and their types, in the order of the silver census table.
# The spelling of population_85_and_ove_percentage is the established column name.
CENSUS_COLUMNS = [
    ("SEX AND AGE!!Total population", "total_population", "bigint"),
    ("SEX AND AGE!!Total population!!Male", "total_population_male_percentage", "float"),
    ("SEX AND AGE!!Total population!!Female", "total_population_female_percentage", "float"),
    ("SEX AND AGE!!Total population!!Sex ratio (males per 100 females)", "sex_ratio_males_per_100_females", "float"),
    ("SEX AND AGE!!Total population!!Under 5 years", "population_under_5_percentage", "float"),
    ("SEX AND AGE!!Total population!!5 to 9 years", "population_5_to_9_percentage", "float"),
    ("SEX AND AGE!!Total population!!10 to 14 years", "population_10_to_14_percentage", "float"),
    ("SEX AND AGE!!Total population!!15 to 19 years", "population_15_to_19_percentage", "float"),
    ("SEX AND AGE!!Total population!!20 to 24 years", "population_20_to_24_percentage", "float"),
    ("SEX AND AGE!!Total population!!25 to 34 years", "population_25_to_34_percentage", "float"),
    ("SEX AND AGE!!Total population!!35 to 44 years", "population_35_to_44_percentage", "float"),
    ("SEX AND AGE!!Total population!!45 to 54 years", "population_45_to_54_percentage", "float"),
    ("SEX AND AGE!!Total population!!55 to 59 years", "population_55_to_59_percentage", "float"),
    ("SEX AND AGE!!Total population!!60 to 64 years", "population_60_to_64_percentage", "float"),
    ("SEX AND AGE!!Total population!!65 to 74 years", "population_65_to_74_percentage", "float"),
    ("SEX AND AGE!!Total population!!75 to 84 years", "population_75_to_84_percentage", "float"),
    ("SEX AND AGE!!Total population!!85 years and over", "population_85_and_ove_percentage", "float"),
    ("SEX AND AGE!!Total population!!Median age (years)", "median_age_years", "float"),
    ("SEX AND AGE!!Total population!!Under 18 years", "population_under_18_percentage", "float"),
    ("SEX AND AGE!!Total population!!16 years and over", "population_16_and_over_percentage", "float"),
    ("SEX AND AGE!!Total population!!18 years and over", "population_18_and_over_percentage", "float"),
    ("SEX AND AGE!!Total population!!21 years and over", "population_21_and_over_percentage", "float"),
    ("SEX AND AGE!!Total population!!62 years and over", "population_62_and_over_percentage", "float"),
    ("SEX AND AGE!!Total population!!65 years and over", "population_65_and_over_percentage", "float"),
    ("SEX AND AGE!!Total population!!18 years and over!!Male", "population_18_and_over_male_percentage", "float"),
    ("SEX AND AGE!!Total population!!18 years and over!!Female", "population_18_and_over_female_percentage", "float"),
    ("SEX AND AGE!!Total population!!18 years and over!!Sex ratio (males per 100 females)", "sex_ratio_18_and_over_males_per_100_females", "float"),
    ("SEX AND AGE!!Total population!!65 years and over!!Male", "population_65_and_over_male_percentage", "float"),
    ("SEX AND AGE!!Total population!!65 years and over!!Female", "population_65_and_over_female_percentage", "float"),
    ("SEX AND AGE!!Total population!!65 years and over!!Sex ratio (males per 100 females)", "sex_ratio_65_and_over_males_per_100_females", "float"),
    ("Race alone or in combination with one or more other races!!Total population!!White", "white_alone_or_combination_percentage", "float"),
    ("Race alone or in combination with one or more other races!!Total population!!Black or African American", "black_alone_or_combination_percentage", "float"),
    ("Race alone or in combination with one or more other races!!Total population!!American Indian and Alaska Native", "american_indian_alaska_native_alone_or_combination_percentage", "float"),
    ("Race alone or in combination with one or more other races!!Total population!!Asian", "asian_alone_or_combination_percentage", "float"),
    ("Race alone or in combination with one or more other races!!Total population!!Native Hawaiian and Other Pacific Islander", "native_hawaiian_pacific_islander_alone_or_combination_percentage", "float"),
    ("Race alone or in combination with one or more other races!!Total population!!Some Other Race", "some_other_race_alone_or_combination_percentage", "float"),
    ("Total housing units", "total_housing_units", "bigint"),
    ("CITIZEN, VOTING AGE POPULATION!!Citizen, 18 and over population", "citizen_18_and_over_population", "bigint"),
    ("CITIZEN, VOTING AGE POPULATION!!Citizen, 18 and over population!!Male", "citizen_18_and_over_population_male_percentage", "float"),
    ("CITIZEN, VOTING AGE POPULATION!!Citizen, 18 and over population!!Female", "citizen_18_and_over_population_female_percentage", "float"),
]


def header_for(year: int | str, suffix: str) -> str:
    return f"{year} {ESTIMATE_MARKER}!!{suffix}"

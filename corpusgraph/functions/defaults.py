"""Default word lists and rules. All are ordinary configuration: pass your own tables instead."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# English calendar words.
WEEKDAYS = "Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split()
MONTHS = "January February March April May June July August September October November December".split()

# Words that never start an entity phrase.
STOP_FIRST = """
The This That These Those A An And But Or For Nor Yet So In On At To Of By With As It He She They We You I
His Her Their Our My Its When Where While After Before During Mr Mrs Ms Dr What Whether Both Every Each Some
Three Two One None More Most Many Few Over Under Once Here There Then Now Year People Both All Any No Not New
Old First Last Next American Americans European African Asian British French German
""".split()

# Words that mark a headline fragment rather than an entity.
REJECT_ANY = """
Has Have Had Is Are Was Were Been Being Will Would Can Could Died Dies Die Dead Killed Kill Kills Said Says Say
Told Tells Part Who Why How What When Really Now Just Still Even About With Without From Into Over Under After
Before Their This That Get Gets Got Make Makes Made Take Takes Took Goes Going Gone Money Yacht War Draft Bowl
Award PM AM Eastern
""".split()

# Titles stripped from the front of a personal name.
TITLES = """
President; Vice President; Judge; Master; Mayor; Senator; Sen; Representative; Rep; Governor; Gov; Congressman;
Dr; Doctor; Professor; Prof; Mr; Mrs; Ms; Detective; Det; Officer; Sergeant; Sgt; Agent; Director; Former DA; DA;
Attorney; Defendant; Former; Chief; Captain; Lieutenant; Lt
""".replace("\n", " ").strip().split("; ")

# Marker words that decide the type of a name, in order.
TYPE_MARKERS = (
    ("Legal", "Court|Circuit|Tribunal|District"),
    (
        "Government",
        "Department|Commission|Bureau|Senate|Congress|Pentagon|FBI|SEC|DOJ|Attorney General|District Attorney",
    ),
    (
        "Places",
        "County|City|Falls|Island|Road|Street|Avenue|Beach|Lake|River|Park|Penitentiary|Prison|USP|FCI"
        "|Detention Center|Metropolitan Detention",
    ),
    (
        "Organizations",
        "Inc|LLC|Corp|Company|Group|Productions|Rescue|Foundation|University|College|Institute|Network|Media"
        "|Partners|Capital|Management|Bank|Mile|Center",
    ),
)


def word_rules(spark: SparkSession) -> DataFrame:
    """word, rule: stop_first, reject_any, weekday or month."""
    rows = [(w, "stop_first") for w in STOP_FIRST]
    rows += [(w, "reject_any") for w in REJECT_ANY]
    rows += [(w, "weekday") for w in WEEKDAYS] + [(w, "month") for w in MONTHS]
    return spark.createDataFrame(rows, "word string, rule string")

"""Explicit schemas of the JSON inputs."""

CHOICE_TASK = (
    "text string, _view_id string, config struct<choice_style:string>, answer string, "
    "accept array<string>, options array<struct<id:string,text:string>>"
)
SPAN_TASK = (
    "text string, answer string, "
    "spans array<struct<token_start:int,token_end:int,label:string>>"
)
COMPARISON = "text string, nlp_pred map<string,string>, hf_pred map<string,string>"
LABEL_COMPARISON = "text string, label array<string>, prediction array<string>"

# Types of report columns that are not plain text.
REPORT_TYPES = {
    "IS_MISSING": "boolean",
    "IS_COMPARATIVE": "boolean",
    "IS_NORMAL": "boolean",
    "IS_NORMAL_FOR_AGE": "boolean",
    "_X": "double",
    "_Y": "double",
    "End Exam Date": "date",
}

"""Declared schemas of the study's source tables.

Fixed values: table layouts a study of this kind exports, so that no file is ever scanned to
infer types.
"""

USER_STUDY_PHASES = "pId string, phaseId string, startDate date, endDate date"
SURVEY_RESPONSES = (
    "pId string, surveyId string, sId string, date date, startTime timestamp, "
    "timeTaken double, goodnessScore double, note string"
)
SURVEY_RESPONSE_DETAILS = "surveyId string, activityId string, score int"
ACTIVITIES = "activityId string, name string"
USER_ACTIVITIES = "activityId string, name string"
USER_ACTIVITY_PREFERENCES = "pId string, activityId string, participantPhaseId string"
PARTICIPANTS = "id long, label string, start_date date, end_date date"
DEVICES = "id string, participant_id long"
MINUTES = (
    "pid string, ts timestamp, heartrate double, hr_zone string, steps int, "
    "calories double, mets double, activity_level string"
)
SLEEP_EPISODES = (
    "pid string, start_ts timestamp, end_ts timestamp, type string, efficiency double, "
    "minutes_asleep double, minutes_awake double, minutes_to_fall_asleep double, "
    "minutes_after_wakeup double, minutes_in_bed double"
)
SLEEP_STAGES = "pid string, ts timestamp, duration_s int, level string, type string"

# One JSON document per raw wearable row: minutes of one day.
MINUTE_DOCUMENT = (
    "struct<date:string,dataset:array<struct<time:string,heartrate:double,steps:int,"
    "calories:double,mets:double,level:string>>>"
)

"""Fixed schemas of the data model, as DDL strings (accepted by readers, ``from_json`` and ``createDataFrame``).

Every reader in the library passes an explicit schema, so no job pays for schema inference over millions of small
JSON files and the column types never drift between runs.
"""

from __future__ import annotations


# ---------------------------------------------------------------------------------------------------------------------
# The job-detail document as frozen in the log table's DDL (field names are case-sensitive for Spark's
# JSON reader, so they are declared exactly as they appear on the wire).
JOB_INFO_DDL = (
    "struct<jobArn:string,jobName:string,jobId:string,jobQueue:string,status:string,"
    "attempts:array<struct<container:struct<containerInstanceArn:string,taskArn:string,exitCode:int,"
    "logStreamName:string,networkInterfaces:array<string>>,startedAt:bigint,stoppedAt:bigint,statusReason:string>>,"
    "statusReason:string,createdAt:bigint,"
    "retryStrategy:struct<attempts:int,evaluateOnExit:array<struct<onReason:string,action:string,onStatusReason:string>>>,"
    "startedAt:bigint,stoppedAt:bigint,dependsOn:array<string>,jobDefinition:string,parameters:string,"
    "container:struct<image:string,command:array<string>,jobRoleArn:string,executionRoleArn:string,"
    "volumes:array<string>,environment:array<struct<name:string,value:string>>,mountPoints:array<string>,"
    "readonlyRootFilesystem:boolean,ulimits:array<string>,exitCode:int,containerInstanceArn:string,taskArn:string,"
    "logStreamName:string,networkInterfaces:array<string>,resourceRequirements:array<struct<value:string,type:string>>,"
    "logConfiguration:struct<logDriver:string,options:struct<`awslogs-group`:string,`awslogs-region`:string,"
    "`awslogs-stream-prefix`:string>,secretOptions:array<string>>,secrets:array<string>>,"
    "timeout:struct<attemptDurationSeconds:int>,tags:struct<resourceArn:string>,propagateTags:boolean,"
    "platformCapabilities:array<string>,eksAttempts:array<string>,isTerminated:boolean>"
)
# ---------------------------------------------------------------------------------------------------------------------

# State-change envelope; the hyphenated name is what arrives on the wire.
STATE_CHANGE_SCHEMA = (
    "version string, id string, `detail-type` string, source string, account string, time string, region string, "
    f"resources array<string>, detail {JOB_INFO_DDL}"
)

# One JSON document per job attempt in the outcome log. ``job_outcome`` holds the job outcome name; the partition
# column ``outcome`` (success / failure) is added by the directory layout.
JOB_LOG_SCHEMA = f"granule_id string, attempt int, job_outcome string, job_info {JOB_INFO_DDL}"

# Processing event (queue message body).
PROCESSING_EVENT_SCHEMA = ("granule_id string, attempt int, debug_bucket string")

# Queue tables: message body plus the failure type attribute.
QUEUE_SCHEMA = ("body string, failure_type string")

# Parsed inventory row; ``inventory`` names the source listing and ``inventory_seq`` is the 0-based row position.
INVENTORY_SCHEMA = (
    "granule_id string, start_datetime timestamp, status string, published boolean"
)

# Storage-inventory snapshot (one partition per ``dt``).
SNAPSHOT_SCHEMA = (
    "bucket string, key string, version_id string, is_latest boolean, is_delete_marker boolean, "
    "last_modified_date timestamp"
)

# Progress through each inventory file.
PROGRESS_SCHEMA = ("inventory string, submitted_count bigint, total_count bigint")

# Active job summaries used by the back-pressure gate.
JOB_SUMMARY_SCHEMA = ("job_id string, status string")

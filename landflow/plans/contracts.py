"""Declared table contracts."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType, VariantType

# The declared activity-event columns, in table order. Every
# column is text except RecordType (integer) and IsSuccess (boolean).
ACTIVITY_COLUMNS = [
    "Id", "RecordType", "CreationTime", "Operation", "OrganizationId", "UserType", "UserKey",
    "Workload", "UserId", "Activity", "EmbedTokenId", "IsSuccess", "RequestId", "ActivityId",
    "BillingType", "ClientIP", "UserAgent", "ItemName", "WorkSpaceName", "CapacityId",
    "CapacityName", "WorkspaceId", "ObjectId", "DataflowId", "DataflowName", "DataflowType",
    "DatasetName", "DatasetId", "DataConnectivityMode", "ArtifactId", "ArtifactName",
    "RefreshType", "LastRefreshTime", "ArtifactKind", "ItemId", "ReportName", "AppName",
    "ReportId", "ReportType", "AppReportId", "DistributionMethod", "ConsumptionMethod", "AppId",
    "DataflowRefreshScheduleType", "ExportedArtifactInfo", "ExportedArtifactDownloadInfo",
    "EndPoint", "HasFullReportAttachment", "SubscriptionDetails", "GatewayId", "DatasourceId",
    "SubfolderId", "SubfolderObjectId", "SubfolderName", "FolderObjectId", "FolderDisplayName",
    "FolderAccessRequests", "TableName", "ArtifactAccessRequestInfo", "Schedules",
    "OriginalOwner", "TakingOverOwner", "SubscribeeInformation", "ExternalSubscribeeInformation",
    "SubscriptionSchedule", "IsTenantAdminApi", "GatewayClustersObjectIds",
    "DatasourceInformations", "ArtifactObjectId",
]
ACTIVITY_INT_COLUMNS = {"RecordType"}
ACTIVITY_TRUTH_COLUMNS = {"IsSuccess"}                       # Python truth of any JSON value
ACTIVITY_FLAG_TEXT_COLUMNS = {"HasFullReportAttachment", "IsTenantAdminApi"}  # 'true' text flags
CATCH_ALL = "AdditionalInfo"
PARTITION = "LoadDate"
PROCESSED_AT = "ProcessingTimestamp"


def _activity_type(name: str):
    if name in ACTIVITY_INT_COLUMNS:
        return IntegerType()
    if name in ACTIVITY_TRUTH_COLUMNS:
        return BooleanType()
    return StringType()


# The stored table: 69 declared columns, the catch-all, then the run columns.
ACTIVITY_SCHEMA = StructType(
    [StructField(n, _activity_type(n)) for n in ACTIVITY_COLUMNS] + [StructField(CATCH_ALL, StringType())]
)

# How records are read: the columns whose meaning depends on the JSON type of
# the value are read as VARIANT and converted afterwards.
ACTIVITY_READ_SCHEMA = StructType(
    [
        StructField(n, VariantType() if n in ACTIVITY_TRUTH_COLUMNS | ACTIVITY_FLAG_TEXT_COLUMNS else _activity_type(n))
        for n in ACTIVITY_COLUMNS
    ]
)

# The keys kept for a workspace row, and the fields dropped from
# each table before it is saved.
WORKSPACE_KEEP = ["id", "name", "isOnDedicatedCapacity", "capacityId", "type", "state"]
DROP = {
    "capacities": ["users"],
    "gateways": ["publicKey", "gatewayAnnotation"],
    "gateway_datasource_users": ["users"],
    "reports": ["users", "subscriptions"],
    "datasets": ["users", "upstreamDatasets"],
    "dataflows": ["users"],
    "tenant_settings": ["enabledSecurityGroups", "properties"],
}

"""Schemas of the landed API responses. A key that is missing in a response is NULL."""

from __future__ import annotations


def _schema(ddl: str) -> str:
    """DDL as one line; Spark's reader takes it as it is."""
    return " ".join(ddl.split())


_ATTRIBUTES = "array<struct<attributeType: struct<keyName: string>, value: string>>"
_CATEGORY = "struct<name: string, `group`: struct<name: string>>"

INVOICES = _schema(
    "id long, accountId long, createDate string, typeCode string, invoiceTotalAmount string, "
    "invoiceTotalRecurringAmount string, invoiceTopLevelItemCount int"
)

INVOICE_ITEMS = _schema(
    f"""
    invoiceId long, billingItemId long, categoryCode string, category {_CATEGORY}, hourlyFlag boolean,
    usageChargeFlag boolean, hostName string, domainName string, location struct<longName: string>, notes string,
    dPart string, totalRecurringAmount string, totalOneTimeAmount string, hourlyRecurringFee string,
    product struct<description: string, taxCategory: struct<name: string>, attributes: {_ATTRIBUTES}>,
    children array<struct<billingItemId: long, categoryCode: string, description: string, recurringFee: string,
      hourlyRecurringFee: string, dPart: string, category: {_CATEGORY},
      product: struct<description: string, itemCategory: struct<name: string>, attributes: {_ATTRIBUTES}>>>
    """
)

ACCOUNT_USAGE = _schema(
    """
    account_id string, month string, currency_code string, billing_country string,
    resources array<struct<resource_id: string, resource_name: string, billable_cost: double,
      billable_rated_cost: double,
      plans: array<struct<plan_id: string, plan_name: string,
        `usage`: array<struct<metric: string, unit_name: string, quantity: double, rateable_quantity: double,
          cost: double, rated_cost: double, discounts: array<struct<discount: double>>, price: array<string>>>>>>>
    """
)

INSTANCE_USAGE = _schema(
    """
    account_id string, resource_instance_id string, resource_instance_name string, resource_group_id string,
    resource_group_name string, month string, plan_id string, plan_name string, billable boolean,
    pricing_plan_id string, pricing_country string, billing_country string, currency_code string,
    pricing_region string, region string, resource_id string, resource_name string,
    `usage` array<struct<metric: string, unit: string, quantity: double, rateable_quantity: double, cost: double,
      rated_cost: double, price: array<string>, discounts: array<struct<discount: double>>, metric_name: string,
      unit_name: string>>
    """
)

RESOURCES = _schema(
    """
    crn string, resource_id string, created_at string, created_by string, updated_at string, updated_by string,
    deleted_at string, deleted_by string, restored_at string, restored_by string, state string, type string,
    extensions struct<Profile: string,
      VirtualMachineProperties: struct<Profile: string, CPUFamily: string, NumberOfVirtualCPUs: string,
        MemorySizeMiB: string, NodeName: string, NumberOfGPUs: string, NumberOfInstStorageDisks: string>,
      BMServerProperties: struct<Profile: string, MemorySizeMiB: string, NodeName: string, NumberOfCores: string,
        NumberOfSockets: string, Bandwidth: string, OSName: string, OSVendor: string, OSVersion: string>,
      VolumeInfo: struct<Capacity: double, IOPS: double>,
      Resource: struct<AvailabilityZone: string, Location: struct<Region: string>, LifecycleAction: string>>
    """
)

TAGS = _schema("crn string, tags array<string>")

CLOUD_USERS = _schema(
    "iam_id string, firstname string, lastname string, state string, email string, added_on string, invitedOn string"
)

USER_ROLES = _schema("email string, `GTM Role` string, OrgName string, Geo string, Market string")

SERVERS = _schema(
    """
    region string, crn string, id string, vcpu struct<count: long, architecture: string, manufacturer: string>,
    memory long, bandwidth long, total_network_bandwidth long, total_volume_bandwidth long,
    primary_network_interface struct<primary_ip: struct<address: string>, subnet: struct<name: string>>,
    numa_count long, vpc struct<name: string>, dedicated_host struct<name: string>, reservation struct<name: string>,
    gpu struct<manufacturer: string, model: string, memory: long, count: long>, lifecycle_state string, status string,
    health_state string, zone struct<name: string>, profile struct<name: string>, image struct<id: string>,
    boot_volume_attachment struct<volume: struct<crn: string, name: string>>,
    volume_attachments array<struct<volume: struct<crn: string, name: string, id: string>>>,
    cpu struct<architecture: string, core_count: long, socket_count: long, threads_per_core: long>,
    disks array<struct<interface_type: string, size: double>>
    """
)

IMAGES = _schema("id string, operating_system struct<name: string, vendor: string, version: string>")
INITIALIZATIONS = _schema("id string, image struct<id: string>")
NETWORKS = _schema("id string, name string")

CLUSTERS = _schema(
    "id string, name string, region string, workerCount long, masterKubeVersion string, state string, "
    "status string, vpcs array<string>"
)

WORKERS = _schema(
    """
    cluster string, id string, lifecycle struct<actualState: string>, health struct<state: string>,
    kubeVersion struct<actual: string>, location string, flavor string, poolName string,
    networkInterfaces array<struct<subnetID: string, ipAddress: string>>
    """
)

NETWORK_STORAGE = _schema(
    "id long, billingItem struct<id: long>, createDate string, capacityGb double, nasType string, notes string, "
    "username string, provisionedIops double"
)

CLASSIC_USERS = _schema(
    """
    accountId long, id long, companyName string, displayName string, firstName string, lastName string,
    createDate string, modifyDate string, statusDate string, iamId string, email string, username string,
    userStatus struct<name: string>, isMasterUserFlag boolean, managedByOpenIdConnectFlag boolean,
    sslVpnAllowedFlag boolean,
    loginAttempts array<struct<createDate: string, ipAddress: string, successFlag: boolean>>
    """
)

ACCOUNT = _schema(
    """
    id long, companyName string, email string, bluemixAccountId string, proofOfConceptAccountFlag boolean,
    accountStatus struct<name: string>, billingInfo struct<createDate: string, currency: struct<name: string>>,
    brand struct<name: string>, internalNotes array<struct<note: string>>,
    masterUser struct<email: string, iamId: string>
    """
)

_INTERFACE = """
    array<struct<name: string, port: int, macAddress: string, primaryIpAddress: string, speed: int, status: string,
      duplexMode: struct<keyname: string>, router: struct<hostname: string, primaryIpAddress: string>,
      uplinkComponent: struct<id: long, networkVlanId: long>,
      primarySubnet: struct<networkIdentifier: string, cidr: int>, ipmiMacAddress: string, ipmiIpAddress: string>>
"""

HARDWARE = _schema(
    f"""
    id long, fullyQualifiedDomainName string, networkGatewayMemberFlag boolean, manufacturerSerialNumber string,
    provisionDate string, notes string, datacenterName string, datacenter struct<name: string>,
    motherboard struct<hardwareComponentModel: struct<longDescription: string>>,
    processors array<struct<hardwareComponentModel: struct<longDescription: string>>>,
    softwareComponents array<struct<softwareLicense: struct<softwareDescription: struct<name: string, version: string>>>>,
    networkVlans array<struct<id: long, vlanNumber: long, fullyQualifiedName: string, name: string,
      vrfDefinitionId: long>>,
    frontendNetworkComponents {_INTERFACE}, backendNetworkComponents {_INTERFACE},
    activeComponents array<struct<modifyDate: string, serialNumber: string,
      hardwareComponentModel: struct<manufacturer: string, name: string,
        hardwareGenericComponentModel: struct<description: string, hardwareComponentType: struct<type: string>>>>>
    """
)

TRUNKS = _schema(
    "componentId long, networkVlan struct<vlanNumber: long, fullyQualifiedName: string, name: string>"
)

ALLOWED_STORAGE = _schema(
    """
    accountId string, id long, hostname string, datacenter struct<id: long, name: string>,
    softwareComponents array<struct<softwareLicense: struct<softwareDescription: struct<name: string>>>>,
    allowedNetworkStorage array<struct<id: long, nasType: string, capacityGb: long, iops: double, bytesUsed: long,
      serviceResourceBackendIpAddress: string, notes: string>>
    """
)

FETCH_ERRORS = _schema("accountId string, error string")

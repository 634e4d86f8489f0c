"""The four payload flattens as spec data.

FIXED VALUES. The paths, prefixes, field names and their order below must
equal the source system's document layout and the established output tables
for results to match; they are stated as plain text in output order. Leg
columns are generated from the rule in :mod:`unfurl.plans.spec` (field-major,
``prefix + slot + "_" + field``), not listed.
"""

from __future__ import annotations

from .spec import FlattenSpec, Group

# ---------------------------------------------------------------------------
# FIXED VALUES: scan JSON response (column ``scanResponse``)
# ---------------------------------------------------------------------------
SCAN = FlattenSpec(
    name="scan",
    groups=(
        Group(
            "bag_resp/hdr/scanner_info",
            ("dev_id", "mac_id", "ver", "serial_nbr"),
        ),
        Group(
            "bag_resp/hdr",
            ("action_cd", "stn_cd"),
        ),
        Group(
            "bag_resp",
            ("ret_code", "error_msg"),
        ),
        Group(
            "bag_resp/resp_info[0]/pax_info",
            ("fn", "ln", "pax_stat"),
            prefix="pax_info_",
        ),
        Group(
            "bag_resp/resp_info[0]/flt_info[0]",
            (
                "orig", "dest", "gate", "flt_nbr", "carr_cd", "lcl_est_arr_dtm", "lcl_est_dep_dtm",
                "lcl_sch_arr_dtm", "lcl_sch_dep_dtm", "flt_status", "nose_nbr", "equip_cd", "acft_nbr",
                "TailNumber", "flt_type", "wideBdyInd", "arrBagClaimUnitId", "eqpDesc", "orig_flt_dt",
                "sector_cd", "isRDLFlt", "isTailTip", "wgtRstInd", "opsLegDepOccurNbr", "opsLegArrOccurNbr",
                "starFltInd", "priorityFltInd", "pier", "bag_status", "scan_dtm", "seq_nbr", "tag_nbr", "type",
                "priority_bag", "bag_primary_type", "curr_sector", "orig_sector", "is_animal_ok", "is_crate_ok",
            ),
            prefix="flt_info_",
        ),
        Group(
            "bag_resp/resp_info[0]/bag_tag[0]",
            (
                "bag_status", "scan_dtm", "seq_nbr", "tag_nbr", "type", "priority_bag", "bag_primary_type",
                "curr_sector", "orig_sector", "is_animal_ok", "is_crate_ok",
            ),
            prefix="bag_tag_",
        ),
        Group(
            "bag_resp/resp_info[0]/bag_tag[0]/last_action",
            ("remark", "seq_nbr", "storage_nbr", "stage_nbr", "flt_nbr", "carr_cd", "stn"),
            prefix="last_action_",
        ),
        Group(
            "bag_resp/resp_info[0]/clm_info",
            ("clm_svc_ret_code", "clm_svc_ret_msg", "bolt_ref_nbr", "wt_ref_nbr"),
            prefix="clm_info_",
        ),
        Group(
            "bag_resp/resp_info[0]/curr_itin/flt_info",
            (
                "flt_nbr", "carr_cd", "orig", "dest", "lcl_est_arr_dtm", "lcl_est_dep_dtm", "lcl_sch_arr_dtm",
                "lcl_sch_dep_dtm", "gate", "intl_ind", "flt_status", "arrBagClaimUnitId", "sector_cd",
            ),
            prefix="resp_curritnr_",
            mode="legs",
            legs=5,
        ),
        Group(
            "bag_resp/resp_info[0]/orig_itin/flt_info",
            (
                "flt_nbr", "carr_cd", "orig", "dest", "lcl_est_arr_dtm", "lcl_est_dep_dtm", "lcl_sch_arr_dtm",
                "lcl_sch_dep_dtm", "gate", "intl_ind", "flt_status", "arrBagClaimUnitId", "sector_cd",
            ),
            prefix="resp_origitnr_",
            mode="legs",
            legs=5,
        ),
        Group(
            "bag_resp/resp_info[0]/flt_avlb_info/flt_avlb",
            ("flt_svc_ret_code", "flt_svc_ret_msg"),
        ),
        Group(
            "bag_resp/resp_info[0]/flt_avlb_info/flt_avlb/flt_info",
            (
                "flt_nbr", "carr_cd", "orig", "dest", "lcl_est_arr_dtm", "lcl_est_dep_dtm", "lcl_sch_arr_dtm",
                "gate", "intl_ind", "equip_cd", "flt_status",
            ),
            prefix="flt_avlb_flt_info_",
        ),
        Group(
            "bag_resp/resp_info[0]",
            (
                "storage_loc", "prnt_ret_code", "prnt_ret_msg", "prnt_error_msg", "fnl_dest_stn_cd", "int_ind",
                "oa_conct_ind",
            ),
            prefix="resp_info_",
        ),
        Group(
            "bag_resp/resp_info[0]/print_parm",
            ("print_type", "print_addr"),
        ),
        Group(
            "bag_resp/resp_info[0]/bag_count",
            (
                "heavyBags", "total_bag_cnt", "total_scan_cnt", "standBags", "missingBags", "quickPaks",
                "valetBags", "min_to_dep",
            ),
        ),
        Group(
            "bag_resp/resp_info[0]/msng_bag_sum_by_sector",
            ("total_prio_bags", "total_city_bags", "total_other_bags"),
        ),
        Group(
            "bag_resp/resp_info[0]/msng_bag_sum_by_sector/total_tb_bags/tb_by_sector",
            ("count", "sector"),
            prefix="tb_by_sector_",
        ),
        Group(
            "bag_resp/resp_info[0]/br_trans_res/pax_info",
            (
                "fn", "ln", "bag_status", "scan_dtm", "tag_nbr", "content_cd", "priority_bag",
                "bag_primary_type", "bag_secondary_type", "curr_sector", "orig_sector",
            ),
            prefix="br_trans_res_pax_info_",
        ),
        Group(
            "bag_resp/resp_info[0]/br_trans_res/scanned_flt_info/flt_info ",
            (
                "flt_nbr", "carr_cd", "orig", "dest", "lcl_est_arr_dtm", "lcl_est_dep_dtm", "lcl_sch_arr_dtm",
                "lcl_sch_dep_dtm", "gate", "intl_ind", "acft_nbr", "TailNumber", "equip_cd", "flt_status",
                "wideBdyInd", "eqpDesc", "orig_flt_dt", "sector_cd", "isRDLFlt", "isTailTip", "wgtRstInd",
                "isCurrent", "isActive", "psgr_status", "auth_to_load", "csr_auth_to_load",
            ),
            prefix="br_trans_res_flt_info_",
        ),
        Group(
            "bag_resp/resp_info[0]/br_trans_batch_res/bag_tag/pax_info",
            (
                "fn", "ln", "tag_nbr", "content_cd", "priority_bag", "bag_primary_type", "bag_secondary_type",
            ),
            prefix="br_trans_batch_res_pax_info_",
        ),
        Group(
            "bag_resp/resp_info[0]/br_trans_batch_res/bag_tag/scanned_flt_info/flt_info",
            (
                "flt_nbr", "carr_cd", "orig", "dest", "lcl_est_arr_dtm", "lcl_est_dep_dtm", "lcl_sch_arr_dtm",
                "lcl_sch_dep_dtm", "gate", "intl_ind", "acft_nbr", "nose_nbr", "TailNumber", "equip_cd",
                "flt_status", "wideBdyInd", "eqpDesc", "sector_cd", "isRDLFlt", "isTailTip", "wgtRstInd",
                "isCurrent", "isActive", "isOriginal", "starFltInd", "priorityFltInd", "psgr_status",
                "auth_to_load", "csr_auth_to_load", "legSeqNbr",
            ),
            prefix="br_trans_batch_res_flt_info_",
        ),
    ),
    null_columns=("error",),
)

# ---------------------------------------------------------------------------
# FIXED VALUES: bm JSON response (column ``bmResponse``)
# ---------------------------------------------------------------------------
BM = FlattenSpec(
    name="bm",
    groups=(
        Group(
            "bagResp/hdr/scannerInformation",
            ("scannerMACAddress", "scannerID", "scannerSerialNumber", "version"),
        ),
        Group(
            "bagResp/bagRespInfo",
            ("storageLocation",),
        ),
        Group(
            "bagResp/hdr",
            ("correlationID", "scanActionCode", "actionStation", "userID", "transactionID"),
        ),
        Group(
            "bagResp",
            ("responseCode", "responseMessage", "bagKey"),
        ),
        Group(
            "bagResp/bagRespInfo/pax",
            ("firstName", "lastName", "paxStat"),
        ),
        Group(
            "bagResp/bagRespInfo/flightInfo",
            (
                "arrivalStation", "carrierCode", "flightNumber", "departureDate", "flightStatus",
                "departureGate", "localEstimatedDepartureDate", "localEstimateArrivalDate",
                "localScheduledArrivalDate", "localScheduledDepartureDate", "departureBagSectorNumber",
                "isInternational", "acftNumber", "isRDLFlight", "tailTipIndicator", "equipmentCode",
                "freezeWeightIndicator", "tailNumber", "carrierType", "opsLegSequenceNumber", "psgrStatus",
                "fltLclOrigDt", "isWideBody", "equipmentDescription", "isCurrent", "isOriginal", "isActive",
                "flightType", "pier", "arrivalBagClaimUnitedID", "sectorCode", "originOccuranceNumber",
                "destinationOccuranceNumber", "isSTARFlight", "isPriorityFlight", "loadStatus",
                "localScanTimestamp", "legSequenceNumber", "bagTagNumber", "type", "isPriority",
                "primaryBagType", "currentSectorNumber", "originalSectorNumber", "isAnimalOK", "isCrateOK",
            ),
            prefix="bagRespInfo_",
        ),
        Group(
            "bagResp/bagRespInfo/bagTag/lastAction",
            (
                "remark", "legSequenceNumber", "storageID", "stageID", "flightNumber", "carrierCode",
                "scanStation", "localScanTimestamp", "legSequenceNumber", "bagTagNumber", "contentCode", "type",
                "isPriority", "primaryBagType",
            ),
            prefix="lastAction1_",
        ),
        Group(
            "bagResp/bagRespInfo/claimInfo",
            (
                "claimServiceResponseCode", "claimServiceResponseMessage", "referenceNumber",
                "worldTracerFileNumber",
            ),
            prefix="claimInfo_",
        ),
        Group(
            "bagResp/bagRespInfo/bagTag/lastAction/lastAction",
            (
                "remark", "legSequenceNumber", "storageID", "stageID", "flightNumber", "carrierCode",
                "scanStation",
            ),
            prefix="lastAction2_",
        ),
        Group(
            "bagResp/bagRespInfo/bagTag",
            (
                "loadStatus", "localScanTimestamp", "legSequenceNumber", "bagTagNumber", "type", "isPriority",
                "primaryBagType", "currentSectorNumber", "originalSectorNumber", "isAnimalOK", "isCrateOK",
            ),
        ),
        Group(
            "bagResp/bagRespInfo/bagTags",
            (
                "localScanTimestamp", "legSequenceNumber", "bagTagNumber", "type", "isPriority",
                "primaryBagType",
            ),
            prefix="bagTags_",
        ),
        Group(
            "bagResp/bagRespInfo/bagTags/lastAction",
            (
                "remark", "legSequenceNumber", "storageID", "stageID", "flightNumber", "carrierCode",
                "scanStation",
            ),
            prefix="bagTags_lastAction_",
        ),
        Group(
            "bagResp/bagRespInfo/currentItin/flightInfo",
            (
                "flightNumber", "carrierCode", "departureStation", "arrivalStation", "localEstimateArrivalDate",
                "localEstimatedDepartureDate", "localScheduledArrivalDate", "localScheduledDepartureDate",
                "departureGate", "isInternational", "flightStatus", "arrivalBagClaimUnitedID",
                "departureBagSectorNumber",
            ),
            prefix="resp_curritnr_",
            mode="legs",
            legs=5,
        ),
        Group(
            "bagResp/bagRespInfo/originalItin/flightInfo",
            (
                "flightNumber", "carrierCode", "departureStation", "arrivalStation", "localEstimateArrivalDate",
                "localEstimatedDepartureDate", "localScheduledArrivalDate", "localScheduledDepartureDate",
                "departureGate", "isInternational", "flightStatus", "arrivalBagClaimUnitedID", "sectorCode",
            ),
            prefix="resp_origitnr_",
            mode="legs",
            legs=5,
        ),
        Group(
            "bagResp/bagRespInfo",
            (
                "printReturnCode", "printReturnDescription", "finalDestinationStationCd", "oaConctIndicator",
            ),
        ),
        Group(
            "bagResp/bagRespInfo/selectedFlights/flightInfo",
            (
                "flightNumber", "carrierCode", "departureStation", "arrivalStation", "localEstimateArrivalDate",
                "departureDate", "departureGate", "opsLegSequenceNumber",
            ),
            prefix="selectedFlights_",
            mode="legs",
            legs=5,
        ),
        Group(
            "bagResp/bagRespInfo/print",
            ("printType", "printAddress"),
            prefix="print_",
        ),
        Group(
            "bagResp/bagRespInfo/bagCount",
            (
                "heavyBags", "totalBagCount", "totalScanCount", "standBags", "missingBags", "quickPaks",
                "valetBags",
            ),
            prefix="bagCount_",
        ),
        Group(
            "bagResp/bagRespInfo/missingBagSummaryBySector",
            ("totalTransferBags", "totalCityBags", "totalOtherBags"),
        ),
        Group(
            "bagResp/bagRespInfo/missingBagSummaryBySector/totalTransferBags/tbBysector",
            ("count", "sector"),
            prefix="missingBagSummaryBySector_tbBysector_",
        ),
        Group(
            "bagResp/bagRespInfo/brTransRes/pax",
            ("firstName", "lastName"),
            prefix="brTransRes_pax_",
        ),
        Group(
            "bagResp/bagRespInfo/brTransRes/bagTag",
            (
                "loadStatus", "localScanTimestamp", "bagTagNumber", "contentCode", "isPriority",
                "primaryBagType", "secondaryBagType", "currentSectorNumber", "originalSectorNumber",
            ),
            prefix="brTransRes_bagtag_",
        ),
        Group(
            "bagResp/bagRespInfo/brTransRes/scannedFltInfo/flightInfo",
            (
                "flightNumber", "carrierCode", "departureStation", "arrivalStation", "localEstimateArrivalDate",
                "localEstimatedDepartureDate", "localScheduledArrivalDate", "localScheduledDepartureDate",
                "departureGate", "isInternational", "acftNumber", "tailNumber", "equipmentCode", "flightStatus",
                "carrierType", "isWideBody", "equipmentDescription", "fltLclOrigDt", "departureBagSectorNumber",
                "isRDLFlight", "tailTipIndicator", "freezeWeightIndicator", "isCurrent", "isActive",
                "psgrStatus", "authorityToLoad", "csrAuthorityToLoad",
            ),
            prefix="brTransRes_scannedFltInfo_",
        ),
        Group(
            "bagResp/bagRespInfo/brTransRes/currentItin/flightInfo",
            (
                "flightNumber", "carrierCode", "departureStation", "arrivalStation", "localEstimateArrivalDate",
                "localEstimatedDepartureDate", "localScheduledArrivalDate", "localScheduledDepartureDate",
                "departureGate", "isInternational", "acftNumber", "tailNumber", "equipmentCode", "flightStatus",
                "carrierType", "isWideBody", "equipmentDescription", "fltLclOrigDt", "departureBagSectorNumber",
                "isRDLFlight", "tailTipIndicator", "freezeWeightIndicator", "isCurrent", "isActive",
                "psgrStatus", "isOriginal", "opsLegSequenceNumber",
            ),
            prefix="brTransRes_currentItin_",
        ),
        Group(
            "bagResp/bagRespInfo/connectingPaxBagRec/ConnectionBags",
            ("bagCount", "sector", "destination", "flightNumber", "minsToDep", "departureGate"),
            prefix="ConnectionBags_",
        ),
        Group(
            "bagResp/bagRespInfo/storageCounts/bagTagsWCHR",
            ("fwdCount", "rearCount"),
            prefix="bagTagsWCHR_",
        ),
        Group(
            "bagResp/bagRespInfo/storageCounts/bagTagsOTHR",
            ("fwdCount", "rearCount"),
            prefix="bagTagsOTHR_",
        ),
        Group(
            "bagResp/bagRespInfo/scanService/flightInfo",
            ("flightNumber", "carrierCode", "departureStation", "arrivalStation", "departureDate"),
            prefix="scanService_flightInfo_",
        ),
        Group(
            "bagResp/bagRespInfo/scanService/flightIndicators",
            (
                "isRDLFlight", "tailTipIndicator", "freezeWeightIndicator", "epnfStatus",
                "acceptLoadPlanProcess", "isMELAck",
            ),
            prefix="scanService_flightIndicators_",
        ),
        Group(
            "bagResp/bagRespInfo/scanService/flightIndicators/xclrIndicators",
            (
                "arcftXCLRCompliant", "btwPaperAndXCLRIndicator", "btwPaperIndicator", "btwState",
                "btwXCLRIndicator", "irropIndicator", "overallPaperAndXCLRIndicator", "overallXCLRComplaint",
                "pltManualOverrideIndicator", "previousXCLRStatus", "xCLRStatusAtIRROPStr", "xCLRStatus",
            ),
            prefix="xclrIndicators_",
        ),
        Group(
            "bagResp/bagRespInfo/bagInfoList/pax",
            (
                "firstName", "lastName", "loadStatus", "legSequenceNumber", "bagTagNumber", "isPriority",
                "primaryBagType",
            ),
            prefix="bagInfoList_pax_",
        ),
        Group(
            "bagResp/bagRespInfo/bagInfoList/ppbmHeldOff",
            ("reasonCode", "reasonDescription", "channelCode", "agentID"),
            prefix="ppbmHeldOff_",
        ),
        Group(
            "bagResp/bagRespInfo/bagInfoList/bagTag",
            ("loadStatus", "localScanTimestamp", "bagTagNumber"),
            prefix="bagInfoList_bagtag_",
        ),
    ),
)

# ---------------------------------------------------------------------------
# FIXED VALUES: cep XML payload (column ``cepPayload``)
# ---------------------------------------------------------------------------
CEP_XML = FlattenSpec(
    name="cep_xml",
    groups=(
        Group(
            "Envelope/eventHeader",
            (
                "eventName", "eventCreationSys", "eventCreationDtm", "eventActionCd", "eventID", "version",
            ),
        ),
        Group(
            "Envelope/Body/bagDetails",
            ("tagNbr", "tagUniqKey", "tagIssDtm", "bagTagActvInd"),
        ),
        Group(
            "Envelope/Body/bagDetails/bagInfo",
            (
                "bagOrigArpt", "bagTermArpt", "tagPrimaryType", "primaryTypePriority", "isPriority", "isHeavy",
                "isRush", "isSelectee", "printerId",
            ),
        ),
        Group(
            "Envelope/Body/bagDetails/paxInfo",
            ("psgrLastName", "psgrFirstName", "psgrPnr"),
        ),
        Group(
            "Envelope/Body/bagDetails/bagCurrentItineraries/bagItineraryDtl",
            (
                "fltLegActvInd", "carrIataCd", "fltNbr", "legLclDepDt", "legGmtDepDt", "fltLclOrigDt",
                "origArptCd", "destArptCd", "cogInd", "psgrChkInSeqNbr", "legSqnrNbr", "bagClassCd",
                "bagSecurityStatCd", "csrAuthReasonCd", "csrAuthReasonDesc", "atlReasonCd", "atlReasonDesc",
                "authToLoad", "bagStatus", "origSector", "currSector", "psgrStatus", "handlingStatus",
                "reflightType", "storageId", "isAdvanced", "isBM",
            ),
            prefix="curr_itne_",
            mode="legs",
            legs=1,
        ),
        Group(
            "Envelope/Body/bagDetails/bagOriginalItineraries/bagItineraryDtl",
            (
                "fltLegActvInd", "carrIataCd", "fltNbr", "legLclDepDt", "legGmtDepDt", "fltLclOrigDt",
                "origArptCd", "destArptCd", "cogInd", "psgrChkInSeqNbr", "legSqnrNbr", "bagClassCd",
                "bagSecurityStatCd", "csrAuthReasonCd", "csrAuthReasonDesc", "atlReasonCd", "atlReasonDesc",
                "authToLoad", "origSector", "currSector", "psgrStatus", "storageId", "isAdvanced",
            ),
            prefix="original_itne_",
            mode="legs",
            legs=1,
        ),
    ),
    extra={
        "scan_detail": (
            "Envelope/Body/bagDetails/bagScans/bagScanDtl",
            (
                "carrIataCd", "fltNbr", "origArptCd", "destArptCd", "scanLclDtm", "uploadScanLclDtm",
                "scanLocation", "pbRemark", "scanType", "agntId",
            ),
        ),
    },
)

# ---------------------------------------------------------------------------
# FIXED VALUES: bm XML payload (column ``bmPayload``)
# ---------------------------------------------------------------------------
BM_XML = FlattenSpec(
    name="bm_xml",
    groups=(
        Group(
            "Envelope/eventHeader",
            (
                "eventName", "eventCreationSys", "eventCreationDtm", "eventActionCd", "eventID", "version",
            ),
        ),
        Group(
            "Envelope/Body/bagDetails",
            ("tagNbr", "tagUniqKey", "tagIssDtm", "bagTagActvInd"),
        ),
        Group(
            "Envelope/Body/bagDetails/bagInfo",
            (
                "bagOrigArpt", "bagTermArpt", "tagPrimaryType", "primaryTypePriority", "isPriority", "isHeavy",
                "isRush", "isSelectee", "printerId",
            ),
        ),
        Group(
            "Envelope/Body/bagDetails/bagInfo/tagBagType",
            ("BagTypeCd", "Priority"),
            rename=(("BagTypeCd", "TagTypeCd"),),
        ),
        Group(
            "Envelope/Body/bagDetails/paxInfo",
            ("psgrLastName", "psgrFirstName", "psgrPnr"),
        ),
        Group(
            "Envelope/Body/bagDetails/bagCurrentItineraries/bagItineraryDtl",
            (
                "fltLegActvInd", "carrIataCd", "fltNbr", "legLclDepDt", "legGmtDepDt", "fltLclOrigDt",
                "origArptCd", "destArptCd", "cogInd", "psgrChkInSeqNbr", "legSqnrNbr", "bagClassCd",
                "bagSecurityStatCd", "isActionLeg", "bagStatus", "psgrStatus", "isAdvanced",
            ),
            prefix="curr_itne_",
            mode="legs",
            legs=1,
        ),
        Group(
            "Envelope/Body/bagDetails/bagOriginalItineraries/bagItineraryDtl",
            (
                "fltLegActvInd", "carrIataCd", "fltNbr", "legLclDepDt", "legGmtDepDt", "fltLclOrigDt",
                "origArptCd", "destArptCd", "cogInd", "psgrChkInSeqNbr", "legSqnrNbr", "bagClassCd",
                "bagSecurityStatCd", "isActionLeg", "bagStatus", "psgrStatus", "isAdvanced",
            ),
            prefix="original_itne_",
            mode="legs",
            legs=1,
        ),
    ),
    extra={
        "scan_detail": (
            "Envelope/Body/bagDetails/bagScans/bagScanDtl",
            ("scanLclDtm", "uploadScanLclDtm", "scanLocation", "pbRemark", "scanType", "agntId"),
        ),
    },
)

SPECS = {s.name: s for s in (SCAN, BM, CEP_XML, BM_XML)}

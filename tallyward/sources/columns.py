"""Column lists of the logs. Specs refer to these names."""

CONVERT_EVENT_COLUMNS = """
advertiser_id app_name app_id app_flag union_imei ip ipc ipb device_model bill_type
event_type invalid_event req_id rit ot click_time_timestamp at_time_timestamp
send_time_timestamp click_send_tdiff convert_click_tdiff convert_send_tdiff fraud_type
external_action landing_type is_search is_reward_ads ac city_id pay_amount
advertiser_first_industry_id advertiser_second_industry_id hour date room_id ecpm_rmb
ecpm_bin
""".split()

CONVERT_WIDE_COLUMNS = """
req_id label union_imei rit site_id site_name media_id media_company_name os_version
model device_vendor ip city_id city_name province_id province_name sys_compiling_time
ad_slot_type connect_type mac imei wifi_ssid wifi_mac imsi oaid idfv global_did
rom_version boot_timestamp system_build_version battery_remaining_pct cpu_num
is_charging free_space_in sdcard_size is_rooted sec_did is_system_adb is_click_acb
sdk_plugin_version access_method carrier_id did ad_sdk_version app_name app_id
app_package_name advertiser_id advertiser_name customer_id customer_name screen_height
screen_width district_id district_name hour advertiser_first_industry_id
advertiser_second_industry_id advertiser_first_industry_name
advertiser_second_industry_name sec_did_2 external_actions deep_external_action
event_type invalid_event is_old_phone phone_launch_date callback_param fraud_type
creative_id ad_id is_new_device cpa_bid pay_amount union_imei_first_time_difference
rit_name uid date classify landing_type os ad_source
""".split()

REQUEST_COLUMNS = """
req_id union_api_status status_code rit site_id site_name media_id media_name
ad_slot_type device_id user_agent device_type ip ipc latitude longitude version
is_paid_app os_type os_version device_vendor device_model model_price connect_type
screen_width screen_height ad_show_position log_timestamp mac imei wifi_ssid imsi
union_imei oaid sha1 idfv global_did applog_did wifi_mac did rom_version ad_sdk_version
power_on_timestamp system_compiling_time system_build_version screen_orientation
city_id province_id screen_bright is_screen_off battery_remaining_pct cpu_max_freq
cpu_min_freq cpu_num is_charging free_space_in sdcard_size is_rooted app_running_time
is_low_power boot_timestamp sec_did whale_decision is_reverse is_limit_delivery
front_intercept_decision front_intercept_detail mediation_req_type is_refuse
waterfall_type is_waterfall_cache is_system_adb is_click_acb last_show_report_detail
sdk_plugin_version access_method union_imei_source carrier_id android_id
engine_status_code basy_antispam_features district_id origin_front_intercept_decision
sec_did_2 antispam_dispose antispam_list_rules antispam_mark_rules
union_imei_first_time_difference p_date hour ad_source final_decision mark_status
""".split()

# Request columns the flagged request log does not have.
UNFLAGGED_ONLY = (
    "user_agent",
    "last_show_report_detail",
    "basy_antispam_features",
    "origin_front_intercept_decision",
    "antispam_mark_rules",
)
BLACK_FLAG = "hit_black_device_flag"

"""Explicit schemas of the persistent tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

VERSION = 40

_FLUX = ", ".join(f"avg_{f} double, avg_{f}_sq double, avg_{f}_weight double, avg_weighted_{f} double, avg_weighted_{f}_sq double" for f in ("f_peak", "f_int"))

DDL = {
    "dataset": "id long, rerun int, process_start_ts timestamp, process_end_ts timestamp, description string",
    "config": "dataset long, section string, key string, value string, type string",
    "frequencyband": "id long, dataset long, freq_central double, freq_low double, freq_high double",
    "skyregion": "id long, dataset long, centre_ra double, centre_decl double, xtr_radius double, x double, y double, z double",
    "image": "id long, dataset long, band long, skyrgn long, stokes int, tau_time double, freq_eff double, freq_bw double, taustart_ts timestamp, rb_smaj double, rb_smin double, rb_pa double, deltax double, deltay double, rms_qc double, rms_min double, rms_max double, detection_thresh double, analysis_thresh double, url string, reason string",
    "imagedata": "image long, fits_header string, fits_data binary",
    "extractedsource": "xtrsrc long, image long, ts timestamp, band string, stokes int, ff_runcat long, ff_monitor long, zone int, ra double, decl double, uew double, uns double, ra_fit_err double, decl_fit_err double, ew_sys_err double, ns_sys_err double, error_radius double, x double, y double, z double, racosdecl double, det_sigma double, semimajor double, semiminor double, pa double, f_peak double, f_peak_err double, f_int double, f_int_err double, chisq double, reduced_chisq double, extract_type int, fit_type int",
    "runningcatalog": "runcat long, dataset long, datapoints long, zone int, wm_ra double, wm_decl double, wm_uew double, wm_uns double, avg_wra double, avg_wdecl double, avg_weight_ra double, avg_weight_decl double, x double, y double, z double, mon_src boolean, forcedfits_count long",
    "runningcatalog_flux": f"runcat long, band string, stokes int, f_datapoints long, {_FLUX}",
    "assocxtrsource": "runcat long, xtrsrc long, type int, distance_arcsec double, r double, v_int double, eta_int double, f_datapoints long",
    "assocskyrgn": "runcat long, skyrgn long, distance_deg double",
    "newsource": "runcat long, trigger_xtrsrc long, previous_limits_image long, newsource_type int",
    "varmetric": "runcat long, v_int double, eta_int double, band string, newsource long, sigma_rms_max double, sigma_rms_min double, lightcurve_max double, lightcurve_avg double, lightcurve_median double",
    "monitor": "id long, dataset long, runcat long, ra double, decl double, name string",
    "rejection": "image long, rejectreason int, comment string",
    "rejectreason": "id int, description string",
}

#: Reasons for which an image is set aside.
REJECT_REASONS = ((0, "rms invalid"), (1, "beam invalid"), (2, "bright source near"), (3, "tau_time invalid"), (4, "contains nan"), (5, "flat image"))


def schema(name: str) -> StructType:
    return StructType.fromDDL(DDL[name])
